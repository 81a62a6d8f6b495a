"""segmint: customer segmentation as Spark DataFrame operators."""

from segmint.spec import DEFAULT_SPEC, SegmentSpec  # noqa: F401

__version__ = "0.1.0"
