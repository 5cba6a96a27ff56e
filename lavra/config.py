"""Rule tables and catalogs.

FIXED VALUES — these must equal the source systems' own lists for the
results to match (keywords, patterns, category sets, header words, column
names, catalogs). They are kept verbatim, in their natural order.
"""

from __future__ import annotations

# ---------------------------------------------------------------- FIXED VALUES
# Procurement: notice categories queried, with their window granularity.
PROCUREMENT_MODALITIES = [
    (4, "monthly", "Concorrência Eletrônica"),
    (5, "monthly", "Concorrência Presencial"),
    (6, "weekly", "Pregão Eletrônico"),
    (8, "monthly", "Dispensa de Licitação"),
]

# Procurement: a notice is kept when its object text contains any of these.
WORKS_KEYWORDS = [
    "obra", "construção", "paviment", "reforma",
    "engenharia", "edificação", "saneamento", "drenagem",
    "ponte", "viaduto", "rodovia", "habitação",
]

# Procurement: works type, first matching pattern wins (case-insensitive).
WORKS_TYPE_RULES = [
    ("paviment|asfalto|calçad", "pavimentação"),
    ("saneamento|esgoto|água|abastecimento", "saneamento"),
    ("escola|creche|ub[sc]|saúde|hospital|cras|creas", "equipamento social"),
    ("ponte|viaduto|rodovia|estrada|túnel", "viário"),
    ("habitação|moradia|conjunto residencial", "habitação"),
    ("drenagem|córrego|galeria", "drenagem"),
    ("praça|parque|quadra|arena|ginásio", "equipamento esportivo/lazer"),
]
WORKS_TYPE_DEFAULT = "construção geral"

# Permits: land-use class, first matching pattern wins (case-insensitive).
LAND_USE_RULES = [
    ("R[1-4]|resid|HIS|HMP", "residencial"),
    ("C[1-4]|comerc", "comercial"),
    ("I[1-4]|indust", "industrial"),
    ("E[1-3]|equip", "equipamento"),
]
LAND_USE_DEFAULT = "outros"

# Permits: a row is the header when it holds at least two of these words.
PERMIT_HEADER_WORDS = ["mes", "mês", "alvara", "alvará", "unidade", "bairro", "descricao", "descrição"]

# Permits: silver column ← normalized source spellings, first present non-null wins.
PERMIT_COLUMN_VARIANTS = [
    ("mes", ["mês", "meses"]),
    ("unidade", ["unidade"]),
    ("administracao_regional", ["administração_regional", "administracao_regional",
                                "subprefeitura", "prefeitura_regional"]),
    ("alvara", ["alvará", "alvara"]),
    ("processo", ["processo"]),
    ("descricao", ["descrição", "descricao"]),
    ("tipo_da_construcao", ["tipo_da_construcao"]),
    ("sql_incra", ["sql_incra"]),
    ("categoria_de_uso", ["categoria_de_uso"]),
    ("zona_de_uso_atual", ["zona_de_uso_atual", "zona_de_uso"]),
    ("zona_de_uso_anterior", ["zona_de_uso_anterior"]),
    ("bairro", ["bairro"]),
    ("endereco", ["endereço", "endereco"]),
    ("area_construcao_m2", ["área_da_construção_m", "area_da_construcao"]),
    ("area_terreno_m2", ["área_do_terreno_m", "area_do_terreno"]),
    ("proprietario", ["proprietário", "proprietario"]),
    ("dt_aprovacao", ["aprovação", "aprovacao"]),
    ("dt_autuacao", ["data_autuação", "dtautuacao"]),
    ("dirigente_tecnico", ["dirigente_técnico", "firma_dirigente_tecnico"]),
    ("responsavel_empresa", ["responsável_pela_empresa", "responsavel_da_firma"]),
    ("autor_projeto", ["autor_do_projeto", "autor_projeto"]),
    ("responsavel_tecnico", ["responsavel_tecnico"]),
]
PERMIT_BLOCKS_DIRECT = "b_locos_p_avimentos_u_nidades"
PERMIT_BLOCKS_PARTS = ["numero_de_blocos", "numero_de_pavimentos", "numero_de_unidades"]
PERMIT_LINK_FRAGMENT = "/documents/d/licenciamento/sissel"
PERMIT_LINK_PATTERN = r"sissel_ano_(\d{4})(?:_(\d{2}))?"

# Mining claims: substances of interest (state SP only).
MINING_STATE = "SP"
MINING_SUBSTANCES = [
    "BASALTO", "GRANITO", "CALCÁRIO", "CALCÁRIO DOLOMÍTICO",
    "DOLOMITO", "QUARTZITO", "ARENITO", "MÁRMORE",
    "AREIA", "AREIA INDUSTRIAL", "AREIA QUARTZOSA",
    "CASCALHO", "SAIBRO",
]
# Mining claims: phase group, first matching set wins.
MINING_PHASE_GROUPS = [
    (["CONCESSÃO DE LAVRA", "LICENCIAMENTO"], "ativo"),
    (["REQUERIMENTO DE LAVRA", "REQUERIMENTO DE LICENCIAMENTO",
      "AUTORIZAÇÃO DE PESQUISA", "REQUERIMENTO DE PESQUISA",
      "DIREITO DE REQUERER A LAVRA"], "em_processo"),
    (["APTO PARA DISPONIBILIDADE"], "disponivel"),
]
# Mining claims: aggregate type, first matching set wins.
MINING_AGGREGATE_GROUPS = [
    (["BASALTO", "GRANITO", "QUARTZITO", "ARENITO", "MÁRMORE"], "rocha_britada"),
    (["CALCÁRIO", "CALCÁRIO DOLOMÍTICO", "DOLOMITO"], "calcario"),
    (["AREIA", "AREIA INDUSTRIAL", "AREIA QUARTZOSA"], "areia"),
    (["CASCALHO", "SAIBRO"], "cascalho_saibro"),
]
OTHER_GROUP = "outros"

# Tenders: positional column names of the monthly CSV (21 source + 2 lineage).
TENDER_COLUMNS = [
    "municipio", "entidade", "cod_licitacao", "modalidade",
    "objeto", "descricao_objeto", "produto_item",
    "qtd_contratada", "unidade_contratada",
    "vl_unit_orcamento_lote", "qtd_orcamento_lote", "un_orcamento_lote",
    "vl_unit_orcamento_item", "qtd_orcamento_item", "un_orcamento_item",
    "num_edital", "dt_edital",
    "cnpj_participante", "nome_participante",
    "resultado_habilitacao", "vl_proposta",
    "periodo", "dt_ingestao",
]
TENDER_MONEY_COLUMNS = ["vl_unit_orcamento_lote", "vl_unit_orcamento_item", "vl_proposta"]
TENDER_QUANTITY_COLUMNS = ["qtd_contratada", "qtd_orcamento_lote", "qtd_orcamento_item"]
TENDER_OBJECT_COLUMN = "Objeto"
TENDER_WORKS_OBJECT = "Obras e servicos de engenharia"

# Investments: registered sources (file type, delimiter, charset).
INVESTMENT_SOURCES = [
    ("investimentos_captados", "csv", ";", "windows-1252"),
    ("investimentos_captados_com_valor", "csv", ";", "windows-1252"),
    ("investimentos_captados_sem_valor", "csv", ";", "windows-1252"),
]

# Delimited text: tokens read as missing even when every column is text.
NA_TOKENS = [
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan",
    "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None",
    "n/a", "nan", "null",
]

# windows-1252 bytes 0x80–0x9F (read as ISO-8859-1 code points U+0080–U+009F)
# and the characters they stand for; the five undefined bytes become U+FFFD.
CP1252_C1_SOURCE = "".join(chr(c) for c in range(0x80, 0xA0))
CP1252_C1_TARGET = (
    "€�‚ƒ„…†‡ˆ‰Š‹Œ�Ž�"
    "�‘’“”•–—˜™š›œ�žŸ"
)
# ------------------------------------------------------------ end FIXED VALUES
