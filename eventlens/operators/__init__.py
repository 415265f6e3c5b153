"""DataFrame-to-DataFrame building blocks shared by batch and streaming plans."""
