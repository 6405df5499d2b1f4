"""Writers for graded data, documents and metrics. Executors write; nothing passes the driver."""
