"""Every registered query; importing this package fills ``REGISTRY``."""

from foldwise.catalog import (augmentation, blending, builder, drift, encoding, errors,  # noqa: F401
                              evaluation, features, imputation, io, linkage, modeling, profiling,
                              selection)
from foldwise.catalog.registry import REGISTRY

__all__ = ["REGISTRY"]
