"""Where tables come from: landing files, the star schema, published versions."""
