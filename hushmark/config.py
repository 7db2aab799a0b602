"""Job parameters, read from the nested JSON that users keep them in."""

from __future__ import annotations

import json
from collections.abc import Mapping
from dataclasses import dataclass
from typing import Any

from hushmark.rules import guidelines
from hushmark.rules.pii import CATEGORIES


@dataclass(frozen=True)
class JobConfig:
    """What a corpus job needs to know.  Sections it does not use are ignored."""

    raw_data_path: str
    file_pattern: str = "*.json"
    version: str = "1.0"
    categories: tuple[str, ...] = CATEGORIES
    min_messages: int = guidelines.MIN_MESSAGES
    max_messages: int = guidelines.MAX_MESSAGES
    vocabulary_limit: int = guidelines.VOCABULARY_LIMIT
    label_tasks: bool = True
    include_metadata: bool = True

    @classmethod
    def from_dict(cls, nested: Mapping[str, Any]) -> JobConfig:
        """From the sections pipeline, data_sources, anonymization, pattern_analysis, output."""
        places = {
            "version": ("pipeline", "version"),
            "raw_data_path": ("data_sources", "raw_data_path"),
            "file_pattern": ("data_sources", "file_pattern"),
            "categories": ("anonymization", "patterns_to_remove"),
            "min_messages": ("pattern_analysis", "min_conversation_length"),
            "max_messages": ("pattern_analysis", "max_conversation_length"),
            "vocabulary_limit": ("pattern_analysis", "vocabulary_size_limit"),
            "label_tasks": ("output", "label_studio_format"),
            "include_metadata": ("output", "include_metadata"),
        }
        given = {
            name: nested[section][key]
            for name, (section, key) in places.items()
            if key in nested.get(section, {})
        }
        if "categories" in given:
            given["categories"] = tuple(given["categories"])
        return cls(**given)

    @classmethod
    def from_json(cls, path: str) -> JobConfig:
        with open(path, encoding="utf-8") as f:
            return cls.from_dict(json.load(f))
