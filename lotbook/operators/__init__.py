from lotbook.operators.lookups import (
    asof_version,
    exact_version,
    named_members,
    own_version,
    value_lookup,
)
from lotbook.operators.reshape import slots_to_rows
from lotbook.operators.values import value_dimension
from lotbook.operators.versions import (
    latest_per_key,
    version_span,
    version_spans,
    versioned_dimension,
    with_next_version,
)

__all__ = [
    "asof_version",
    "exact_version",
    "latest_per_key",
    "named_members",
    "own_version",
    "slots_to_rows",
    "value_dimension",
    "value_lookup",
    "version_span",
    "version_spans",
    "versioned_dimension",
    "with_next_version",
]
