"""All registered queries."""

from webgrain.catalog import evaluation, html, numbers, rows, streams, text  # noqa: F401
from webgrain.catalog.registry import ORACLE, QUERIES  # noqa: F401
