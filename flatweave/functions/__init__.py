from flatweave.functions.expressions import (
    field_or_null,
    id_text,
    param_value,
    shard_date,
    spread,
    text_value,
)

__all__ = ["field_or_null", "id_text", "param_value", "shard_date", "spread", "text_value"]
