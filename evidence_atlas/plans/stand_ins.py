"""How the given tables stand in for place-name tables, in Spark and in DuckDB."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Letters of product names as characters of place names.
LETTERS, SIGNS = "aeioudlgrn", "沢の澤ヶ川国ガ之山が"


def jp(c: str) -> Column:
    return F.translate(c, LETTERS, SIGNS)


def jp_sql(c: str) -> str:
    return f"translate({c}, '{LETTERS}', '{SIGNS}')"


def lat(k: str) -> Column:
    return F.expr(f"24 + cast({k} * 7919 % 20000 as double) / 1000")


def lon(k: str) -> Column:
    return F.expr(f"123 + cast({k} * 104729 % 22000 as double) / 1000")


def lat_sql(k: str) -> str:
    return f"(24 + ({k} * 7919 % 20000)::double / 1000)"


def lon_sql(k: str) -> str:
    return f"(123 + ({k} * 104729 % 22000)::double / 1000)"


#: A dictionary of telling elements for product names.
ELEMENTS = [
    {"id": "red", "surfaces": ["red", "crimson"], "readings": ["レド"], "hazards": ["landslide", "flood"], "specificity": 0.9},
    {"id": "ring", "surfaces": ["ring"], "hazards": ["flood"], "specificity": 0.5},
    {"id": "cold", "surfaces": ["cold", "ld"], "hazards": ["avalanche"], "specificity": 0.7},
    {"id": "anvil", "surfaces": ["anvil"], "hazards": ["rockfall", "flood"], "specificity": 0.2},
    {"id": "old", "surfaces": ["old "], "hazards": ["erosion"], "specificity": 0.35},
]
ELEMENTS_SQL = """(select * from (values
  ('red', 0, 'red', 0, 0.9, ['landslide','flood']), ('red', 0, 'crimson', 1, 0.9, ['landslide','flood']), ('ring', 1, 'ring', 0, 0.5, ['flood']),
  ('cold', 2, 'cold', 0, 0.7, ['avalanche']), ('cold', 2, 'ld', 1, 0.7, ['avalanche']), ('anvil', 3, 'anvil', 0, 0.2, ['rockfall','flood']),
  ('old', 4, 'old', 0, 0.35, ['erosion'])) as e(element_id, element_ord, surface, surf_ord, specificity, hazards))"""
