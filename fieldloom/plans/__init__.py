"""End-to-end pipelines composed of the operators, and the registered queries."""
