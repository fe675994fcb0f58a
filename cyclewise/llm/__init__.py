"""Training-data operators over text and embedding tables (one module per operator)."""
