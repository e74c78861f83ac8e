"""Readers, writers and the driver-table fixtures."""

from ratecraft.sources.io import (
    RATINGS_SCHEMA, read_ratings, read_movies, write_ratings_text,
    write_movies_text, write_triples, read_triples, write_predictions,
    read_predictions, literal_table,
)
from ratecraft.sources.fixtures import (
    load_ratings, load_items, load_items_dirty, load_ratings_sparse,
    load_corrections, load_events,
)

__all__ = [
    "RATINGS_SCHEMA", "read_ratings", "read_movies", "write_ratings_text",
    "write_movies_text", "write_triples", "read_triples", "write_predictions",
    "read_predictions", "literal_table", "load_ratings", "load_items",
    "load_items_dirty", "load_ratings_sparse", "load_corrections", "load_events",
]
