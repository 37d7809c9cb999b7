"""Where the star tables come from and where they are written."""
