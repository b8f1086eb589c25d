from flowscope.sources.tables import table, derived, TABLES  # noqa: F401
from flowscope.sources.logs import (  # noqa: F401
    render_log_lines, read_log_text, log_lines, valid_log_lines, parse_log_lines, parsed_log,
    log_parse_rejects, log_text_path, EVENTS_YEAR_MONTH,
)
from flowscope.sources.flows import (  # noqa: F401
    flow_view, flows, flow_lines, flow_drops, flow_text_path, flow_parse_rejects, format_flow_lines, parse_flow_lines, read_flow_text, read_flow_socket,
)
