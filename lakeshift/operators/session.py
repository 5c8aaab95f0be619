"""What a run is set up with, and whether an earlier run's state may be used: a few values on the driver."""

from __future__ import annotations

import hashlib
import json
from dataclasses import asdict, dataclass, field
from datetime import datetime, timezone

from lakeshift.sources.rules import Rules


class SetupError(ValueError):
    pass


@dataclass(frozen=True)
class Setup:
    """Source and target without passwords, the snapshot that all readers share, the split size, and the rules."""

    source: str
    target: str
    snapshot: str | None = None
    split_bytes: int = 0
    split_max_parts: int = 0
    filters: str = "[]"

    @classmethod
    def of(cls, source: str, target: str, rules: Rules | None = None, **more) -> Setup:
        import re

        scrub = lambda uri: re.sub(r"(://[^:/@\s]*):[^@/\s]*@", r"\1:****@", uri)
        return cls(scrub(source), scrub(target), filters=json.dumps([asdict(r) for r in (rules or Rules()).rules]), **more)

    @property
    def digest(self) -> str:
        return hashlib.sha256(json.dumps(asdict(self), sort_keys=True).encode()).hexdigest()

    def check(self, old: Setup, consistent: bool = True) -> None:
        """An earlier run's state is valid only for the same setup; another snapshot is fine where consistency isn't asked for."""
        for name, value in asdict(old).items():
            if value != getattr(self, name) and not (name == "snapshot" and not consistent):
                raise SetupError(f"{name} was {value!r} and is {getattr(self, name)!r}")


@dataclass
class Sections:
    """Which parts of a catalog were fetched, how long each took, and the commands that were run."""

    fetched: dict[str, int] = field(default_factory=dict)
    commands: list[tuple[str, str]] = field(default_factory=list)

    def done(self, name: str, duration_ms: int) -> None:
        self.fetched[name] = duration_ms

    def missing(self, names: list[str]) -> list[str]:
        return [n for n in names if n not in self.fetched]

    def total_ms(self) -> int:
        return sum(self.fetched.values())

    def log(self, command: str) -> None:
        self.commands.append((datetime.now(timezone.utc).isoformat(), command))
