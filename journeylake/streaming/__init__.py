"""File streams and the pipelines they drive."""
