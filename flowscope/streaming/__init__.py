from flowscope.streaming.runner import (  # noqa: F401
    table_stream, flows_stream, log_stream, keyed_window_stream, run_foreach_batch, run_append, read_sink,
    run_to_end, running_total_stream, latest_top_k_stream, change_parameters, run_console,
)
