"""Select applications from large landed collections and extract their text."""
