"""Sources and sinks."""

from larkspan.sources.blocks import BlocksSource, register_blocks
from larkspan.sources.files import FORMATS, read_files, round_trip, write_files
from larkspan.sources.jdbc import read_table, write_table
from larkspan.sources.steps import StepsSource, register

__all__ = ["FORMATS", "BlocksSource", "StepsSource", "read_files", "read_table", "register", "register_blocks", "round_trip", "write_files", "write_table"]
