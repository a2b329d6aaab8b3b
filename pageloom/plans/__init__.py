"""Session settings, materialisation and the end-to-end jobs."""
