"""Query catalogue over the driver tables, its SQL oracle and end-to-end jobs."""
