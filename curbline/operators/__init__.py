"""DataFrame-to-DataFrame operators shared by the models."""
