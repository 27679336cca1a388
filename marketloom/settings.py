"""Switches of the jobs, read from names and texts (such as environment variables) once, and passed on as values."""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from dataclasses import dataclass, fields

OFF = ("0", "false", "no", "off")
ON = ("1", "true", "yes", "on")


@dataclass(frozen=True)
class Settings:
    lake_root: str = ""
    checkpoint_dir: str = ""
    exchange: str = "NSE"
    symbols: str = ""
    scheme_codes: str = ""
    limit: int | None = None
    interval: str = "1h"
    period: str = "730d"
    start: str = ""
    end: str = ""
    batch_size: int = 25
    quote_batch: int = 300
    retries: int = 3
    batched: bool = True
    predictions: bool = True
    calibrate: bool = False

    @classmethod
    def read(cls, values: Mapping[str, str], prefix: str = "MARKETLOOM_") -> Settings:
        """Settings out of texts; blanks keep the default, a text that doesn't fit its kind is an error."""
        found = {}
        for f in fields(cls):
            text = (values.get(prefix + f.name.upper()) or "").strip()
            if not text:
                continue
            if f.type == "bool":
                if text.lower() not in ON + OFF:
                    raise ValueError(f"{prefix}{f.name.upper()}: {text!r} is neither on nor off")
                found[f.name] = text.lower() in ON
            elif f.type.startswith("int"):
                found[f.name] = int(text)
                if found[f.name] < 1:
                    raise ValueError(f"{prefix}{f.name.upper()} must be at least 1")
            else:
                found[f.name] = text
        return cls(**found)

    def required(self, *names: str) -> Settings:
        """These settings; an error if one of ``names`` is blank."""
        missing = [n for n in names if not getattr(self, n)]
        if missing:
            raise ValueError("not set: " + ", ".join(missing))
        return self


def selected(asked: Iterable[str] | None, known: Iterable[str]) -> list[str]:
    """The known names that were asked for, in the order of the known ones; all of them if nothing was asked for."""
    wanted = None if asked is None else set(asked)
    return [k for k in known if wanted is None or k in wanted]
