"""Writers for the outputs of every stage."""
