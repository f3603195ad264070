"""Jobs and queries over the star schema."""
