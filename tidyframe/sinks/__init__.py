"""Writers: CSV / JSON / Parquet / XML with explicit save mode and layout."""

from tidyframe.sinks.write import SAVE_MODES, SINK_FORMATS, SinkSpec, prepare_layout, write_sink

__all__ = ["SAVE_MODES", "SINK_FORMATS", "SinkSpec", "prepare_layout", "write_sink"]
