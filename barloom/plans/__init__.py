"""Physical choices that need a look at the data: broadcast sizes and series pieces."""
