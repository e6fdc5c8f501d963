"""cladeworks: phylogenomics analytics expressed as PySpark DataFrame jobs."""
