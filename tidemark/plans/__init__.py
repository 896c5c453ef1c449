"""Composed flows."""

from .drugs import all_studies, build_drug_graph
from .social import (
    GRAPH_KEYS, archive_to_graph, archive_to_store, build_social_graph, rehydrate, search_time_range,
    search_to_archive, to_archive,
)
from .stored import (
    NAMED_GRAPH, assign_ids, merge_edges_stored, merge_named_graph, merge_nodes_stored, register_names,
)

__all__ = [
    "GRAPH_KEYS", "NAMED_GRAPH", "all_studies", "archive_to_graph", "archive_to_store", "assign_ids", "build_drug_graph",
    "build_social_graph", "merge_edges_stored", "merge_named_graph", "merge_nodes_stored", "register_names", "rehydrate",
    "search_time_range", "search_to_archive", "to_archive",
]
