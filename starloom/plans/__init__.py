"""End-to-end pipelines, the binding of test tables and the catalogue of registered queries."""
