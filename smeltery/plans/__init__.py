"""The stages of a pipeline and the pipeline itself."""
