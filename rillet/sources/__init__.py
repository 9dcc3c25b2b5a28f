from .lines import ARRIVAL, json_line, separator_line, table_lines, xml_line
from .settings import read_format, read_rules, read_settings
from .streams import kafka_lines, text_lines

__all__ = ["ARRIVAL", "json_line", "kafka_lines", "read_format", "read_rules", "read_settings",
           "separator_line", "table_lines", "text_lines", "xml_line"]
