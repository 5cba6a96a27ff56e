"""End-to-end jobs (procurement, tenders, investments, permits, mining) and the
queries registered for the driver over its tables."""
