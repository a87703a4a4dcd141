"""Rule-level operators: summary normalisation and single-rule execution."""
