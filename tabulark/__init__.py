"""Settlement warehouse on Spark: stg feeds -> dds detail layer -> cdm marts."""

__version__ = "0.1.0"
