"""Document queries and grouped statistics on Spark DataFrames."""

from docspark.model import DocModel, array_of, field, get_model, map_of, object_of, register_model
from docspark.operators.aggregate import (
    Spec, aggregate, aggregate_multi, aggregate_multi_long, by_component, by_duration, by_field,
    by_interval, by_ranges, to_documents, top_groups,
)
from docspark.operators.find import count, find, pages, project, stream
from docspark.operators.mutate import delete, delete_keys, unmatched_keys, update, upsert
from docspark.operators.predicates import (
    Doc, all_of, any_of, match_all, none_of, register_operator,
)
from docspark.operators.relations import has_child, has_parent
from docspark.sources.collection import Collection
from docspark.sources.indexes import (
    catalog_indexes, first_match, folder_indexes, glob_filter, read_indexes,
)

__all__ = [
    "Collection", "Doc", "DocModel", "Spec", "aggregate", "aggregate_multi", "aggregate_multi_long",
    "all_of", "any_of", "array_of", "by_component", "by_duration", "by_field", "by_interval",
    "by_ranges", "catalog_indexes", "count", "delete", "delete_keys", "field", "find",
    "first_match", "folder_indexes", "get_model", "glob_filter", "has_child", "has_parent", "map_of", "match_all",
    "none_of", "object_of", "pages", "project", "read_indexes", "register_model", "register_operator",
    "stream", "to_documents", "top_groups", "unmatched_keys", "update", "upsert",
]
