"""DataFrame -> DataFrame operators; each runs unchanged on batch or stream."""

from ferryline.operators.changes import (
    after_text,
    expand_struct,
    keep_fields,
    payload_text,
    unwrap_after,
    unwrap_after_in_arrow,
    unwrap_after_three_step,
    with_parsed,
)
from ferryline.operators.decode import decode_messages
from ferryline.operators.lines import keyed_messages, split_fields
from ferryline.operators.typed import Route, route_records, typed_select

__all__ = [
    "Route",
    "after_text",
    "decode_messages",
    "expand_struct",
    "keep_fields",
    "keyed_messages",
    "payload_text",
    "route_records",
    "split_fields",
    "typed_select",
    "unwrap_after",
    "unwrap_after_in_arrow",
    "unwrap_after_three_step",
    "with_parsed",
]
