"""DataFrame -> DataFrame building blocks of the layers."""
