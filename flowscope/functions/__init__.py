from flowscope.functions.parse import (  # noqa: F401
    IPV4_PATTERN, FLOW_LINE_PATTERN, is_ipv4_host, field, last_field, bytes_present,
    log_timestamp, flow_timestamp, subnet16, subnet24, ip_of_user,
)
from flowscope.functions.hashing import unit_hash, hash_keep, HASH_A, HASH_B  # noqa: F401
