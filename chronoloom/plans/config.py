"""Configuration as frozen values: defaults, a mapping, then environment variables."""

from __future__ import annotations

import os
from collections.abc import Mapping
from dataclasses import dataclass, fields, replace

TRUE, FALSE = {"1", "true", "yes", "on"}, {"0", "false", "no", "off"}


def parse_bool(value) -> bool | None:
    """True, false, or None for what is neither (automatic)."""
    if isinstance(value, bool) or value is None:
        return value
    v = str(value).strip().lower()
    return True if v in TRUE else False if v in FALSE else None


@dataclass(frozen=True)
class Config:
    """Settings of a run. Each can be given by the mapping or by CHRONOLOOM_<NAME>."""

    data_dir: str = "data"
    output_dir: str = "output"
    scope: str = "all"
    force: bool = False
    embed_dimension: int = 64
    embed_batch: int = 64
    top_k: int = 16
    block_size: int = 128
    max_iter: int = 10
    lexical_weight: float = 0.5
    min_confidence: float = 0.0
    request_retries: int = 3
    max_tokens: int = 1024
    most_tokens: int = 16384

    @classmethod
    def load(cls, given: Mapping | None = None, environ: Mapping | None = None) -> Config:
        environ = os.environ if environ is None else environ
        out = cls()
        for f in fields(cls):
            value = (given or {}).get(f.name)
            value = environ.get(f"CHRONOLOOM_{f.name.upper()}", value)
            if value is None:
                continue
            kind = type(getattr(out, f.name))
            value = bool(parse_bool(value)) if kind is bool else kind(value)
            out = replace(out, **{f.name: value})
        return out

    @classmethod
    def from_yaml(cls, path: str) -> Config:
        """From a flat YAML file; needs a YAML library."""
        import yaml

        with open(path, encoding="utf-8") as f:
            return cls.load(yaml.safe_load(f) or {})
