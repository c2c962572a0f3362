"""The steps of one transfer: filter, project, write, verify."""
