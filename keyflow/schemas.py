"""Table schemas and the fixed names of the data model."""

from pyspark.sql import types as T

# Names, prefixes, defaults and enum symbols every producer and consumer agrees on.
INBOUND_TOPIC = "customer.ingest.in"
OUTBOUND_TOPIC = "customer.ingest.out"
IDEMPOTENCY_HEADER = "idempotency-key"
OFFSET_KEY_PREFIX = "dedup:offset:"
IDEMPOTENCY_KEY_PREFIX = "dedup:idemp:"
DEDUP_TTL = "7 days"
POLL_SIZE = 25
LOCK_WINDOW = "10 seconds"
OUTBOUND_FLAG = "customer-ingest.outbound-publish"
OUTBOUND_FLAG_DEFAULT = True
CUSTOMER_CONTEXT = "customer"
APPLICATION_CONTEXT = "application"
ANONYMOUS = "anonymous"
PLACEHOLDER_SDK_KEY = "sdk-placeholder-key"
PROCESSED = "PROCESSED"
FAILED = "FAILED"
DUPLICATE_SKIPPED = "DUPLICATE_SKIPPED"
LOCK_NOT_ACQUIRED = "LOCK_NOT_ACQUIRED"
OUTCOMES = [PROCESSED, DUPLICATE_SKIPPED, LOCK_NOT_ACQUIRED, FAILED]
WIRE_STATUS = {PROCESSED: "PROCESSED", DUPLICATE_SKIPPED: "SKIPPED_DUPLICATE", FAILED: "FAILED"}


_TYPES = {
    "string": T.StringType(),
    "int": T.IntegerType(),
    "bigint": T.LongType(),
    "binary": T.BinaryType(),
    "boolean": T.BooleanType(),
    "timestamp": T.TimestampType(),
}


def struct(**fields: str | T.DataType) -> T.StructType:
    """A struct of nullable fields, by type name or type."""
    return T.StructType([T.StructField(n, _TYPES[t] if isinstance(t, str) else t) for n, t in fields.items()])


ADDRESS = struct(street="string", city="string", state="string", zip="string")
EVENT = struct(customerId="string", phoneNumber="string", address=ADDRESS)
HEADERS = T.ArrayType(struct(key="string", value="binary"))
_RECORD = {
    "topic": "string",
    "partition": "int",
    "offset": "bigint",
    "timestamp": "timestamp",
    "arrival_ts": "timestamp",
}

ENVELOPE = struct(**_RECORD, key="string", headers=HEADERS, event=EVENT)
RAW_ENVELOPE = struct(**_RECORD, key="binary", headers=HEADERS, value="binary")
OUTCOME = struct(
    **_RECORD,
    key="string",
    headers=HEADERS,
    event=EVENT,
    dedup_key="string",
    outcome="string",
    reason="string",
    dedup_reason="string",
    batch_id="bigint",
)
CUSTOMER = struct(
    customerId="string",
    phoneNumber="string",
    address=ADDRESS,
    updatedAt="timestamp",
    lastInboundTopic="string",
    lastInboundPartition="int",
    lastInboundOffset="bigint",
    lastInboundTimestamp="timestamp",
    lastInboundArrival="timestamp",
)
PROCESSED_EVENT = struct(
    customerId="string",
    phoneNumber="string",
    address=ADDRESS,
    status="string",
    processedAt="string",
    reason="string",
    inboundTopic="string",
    inboundPartition="int",
    inboundOffset="bigint",
)
FLAG_RULES = struct(
    flag_key="string",
    context_kind="string",
    context_key="string",
    enabled="boolean",
    rollout_bp="int",
)
FLAG_HISTORY = T.StructType([*FLAG_RULES.fields, T.StructField("valid_from", T.TimestampType())])
