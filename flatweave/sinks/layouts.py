"""Names of the two table layouts."""

SHARDED = "sharded"
PARTITIONED = "partitioned"
