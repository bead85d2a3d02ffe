"""The domain tables, controls, explorations and models, composed from the operators."""
