"""Reading existing settings files into plain arguments (driver side, small files).

* format files: one JSON object ``{"field": "Type", ...}`` in field order;
* rule files: one rule per line;
* a settings file of ``<entry key="...">value</entry>`` elements.
"""

from __future__ import annotations

import json
import xml.etree.ElementTree as ET

from ..types import Schema, as_schema


def read_format(path: str) -> Schema:
    with open(path, encoding="utf-8") as fh:
        return as_schema(json.loads(fh.read()))


def read_rules(path: str) -> list[str]:
    with open(path, encoding="utf-8") as fh:
        return fh.read().splitlines()


def read_settings(path: str) -> dict[str, str]:
    """``key -> text`` of every ``entry`` element, unstripped (a separator may be a tab)."""
    root = ET.parse(path).getroot()
    return {e.get("key"): e.text or "" for e in root.iter("entry") if e.get("key")}
