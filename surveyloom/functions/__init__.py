from surveyloom.functions.columns import (
    complete, dot, doubles, hash52, ident, literal, local_table, numeric_columns, quote, require_columns, sq_dist,
    text_literal, unpivot, value_or_null,
)
from surveyloom.functions.runtime import cut_lineage, ensure_checkpoint_dir, in_parallel, scratch_path, small_methods

__all__ = [
    "complete", "dot", "doubles", "hash52", "ident", "literal", "local_table", "numeric_columns", "quote",
    "require_columns", "sq_dist", "text_literal", "unpivot", "value_or_null",
    "cut_lineage", "ensure_checkpoint_dir", "in_parallel", "scratch_path", "small_methods",
]
