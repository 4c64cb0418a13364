"""Part of kelpforge; see the README for the map."""
