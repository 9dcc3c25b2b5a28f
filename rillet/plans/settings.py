"""A :class:`LogFlow` and stream settings from an existing settings file.

The keys below are those such files already use; every value becomes a plain
argument. Durations keep their units: the batch interval in seconds, the
window length and slide in milliseconds.
"""

from __future__ import annotations

import os
from collections.abc import Mapping
from dataclasses import dataclass

from ..sources.settings import read_format, read_rules, read_settings
from .flow import DEFAULT_EXTRA_SQL, LogFlow

# Setting keys.
KEY_FORMAT = "stream.input.format"
KEY_SEPARATOR = "stream.input.separator"
KEY_INPUT_FORMAT_FILE = "stream.input.formatFilePath"
KEY_OUTPUT_FORMAT_FILE = "stream.output.formatFilePath"
KEY_RULE_FILE = "rule.filePath"
KEY_EXTRA_ENABLE = "stream.extraSQL.enable"
KEY_EXTRA_SQL = "stream.extraSQL.command"
KEY_WINDOW_SQL = "stream.sql.command"
KEY_BATCH_SECONDS = "stream.batchInterval"
KEY_WINDOW_MS = "stream.window.length"
KEY_SLIDE_MS = "stream.window.slide"
KEY_OUTPUT_PATH = "stream.output.savePath"
KEY_SQL_OUTPUT_PATH = "stream.sql.savePath"
KEY_TOPICS = "zookeeper.topics"


@dataclass
class StreamSettings:
    flow: LogFlow
    batch_seconds: float
    output_path: str | None
    sql_output_path: str | None
    topics: str | None


def _path(base_dir: str, p: str) -> str:
    p = p.strip()
    return p if os.path.isabs(p) else os.path.join(base_dir, p)


def flow_from_settings(settings: Mapping[str, str] | str, base_dir: str | None = None,
                       **overrides) -> StreamSettings:
    """Build the flow from a settings mapping (or the path of a settings file).

    Relative file paths are resolved against ``base_dir`` (default: the
    settings file's folder). ``overrides`` are passed to :class:`LogFlow`.
    """
    if isinstance(settings, str):
        base_dir = base_dir or os.path.dirname(os.path.abspath(settings))
        settings = read_settings(settings)
    base_dir = base_dir or os.getcwd()
    get = settings.get
    extra = None
    if (get(KEY_EXTRA_ENABLE) or "false").strip().lower() == "true":
        extra = get(KEY_EXTRA_SQL) or DEFAULT_EXTRA_SQL
    batch_seconds = float((get(KEY_BATCH_SECONDS) or "2").strip())
    args = dict(
        input_schema=read_format(_path(base_dir, settings[KEY_INPUT_FORMAT_FILE])),
        output_schema=read_format(_path(base_dir, settings[KEY_OUTPUT_FORMAT_FILE])),
        rules=[r for r in read_rules(_path(base_dir, settings[KEY_RULE_FILE]))],
        fmt=(get(KEY_FORMAT) or "separator").strip(),
        separator=get(KEY_SEPARATOR) or "\t",
        extra_sql=extra,
        window_sql=get(KEY_WINDOW_SQL),
        window_length=int((get(KEY_WINDOW_MS) or "18000").strip()),
        window_slide=int((get(KEY_SLIDE_MS) or "6000").strip()),
        batch_interval=round(batch_seconds * 1000),
        # as settings files of this kind mean it: entries count wherever they stand
        xml_any_depth=True,
    )
    args.update(overrides)
    return StreamSettings(
        flow=LogFlow(**args),
        batch_seconds=batch_seconds,
        output_path=(get(KEY_OUTPUT_PATH) or "").strip() or None,
        sql_output_path=(get(KEY_SQL_OUTPUT_PATH) or "").strip() or None,
        topics=(get(KEY_TOPICS) or "").strip() or None,
    )
