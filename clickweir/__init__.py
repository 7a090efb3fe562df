"""clickweir: a clickstream lakehouse written as PySpark DataFrame jobs.

Layers: raw dump files -> cleaned Silver edges -> Gold aggregates on per-language
title ids -> ready-made insight tables -> parameterised analytical queries.
"""

from clickweir.plans.lakehouse import Lakehouse
from clickweir.session import shared_dir, tune

__all__ = ["Lakehouse", "shared_dir", "tune"]
