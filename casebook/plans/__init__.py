"""ML stages and the flows that fit, gate and apply them."""
