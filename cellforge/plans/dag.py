"""Pipelines as graphs of targets, and signed version tokens."""

from __future__ import annotations

import hashlib
import hmac
import os
import secrets
import time
from dataclasses import dataclass, field
from functools import cache

from .releases import is_version


@dataclass
class Target:
    name: str
    stage: str = ""
    depends: list[str] = field(default_factory=list)


def plan(targets: list[Target], exclude: tuple[str, ...] = ()) -> list[str]:
    """Topological order; `[auto]` stands for all grid and ingest targets; unknown or circular dependencies are errors."""
    live = {t.name: t for t in targets if t.name not in exclude}
    auto = sorted(n for n, t in live.items() if t.stage in ("grid", "ingest"))
    edges = {n: sorted(set(auto if t.depends == ["auto"] else t.depends) - {n}) for n, t in live.items()}
    for n, ds in edges.items():
        for d in ds:
            if d not in live:
                raise ValueError(f"{n} depends on undefined target {d}")
    out: list[str] = []
    state: dict[str, int] = {}

    def visit(n: str) -> None:
        if state.get(n) == 1:
            raise ValueError(f"circular dependency at {n}")
        if n not in state:
            state[n] = 1
            for d in edges[n]:
                visit(d)
            state[n] = 2
            out.append(n)

    for n in sorted(live):
        visit(n)
    return out


@cache
def _own_secret() -> str:
    return secrets.token_hex(32)


def token_secret(env: str = "TOKEN_SECRET") -> str:
    """The environment's secret, else one of this process."""
    return os.environ.get(env) or _own_secret()


def sign(version: str, secret: str, expires: int) -> str:
    body = f"{version}.{expires}"
    return f"{body}.{hmac.new(secret.encode(), body.encode(), hashlib.sha256).hexdigest()}"


def verify(token: str | None, secret: str, now: float | None = None) -> str | None:
    """The version of a valid, unexpired token, else None."""
    parts = (token or "").split(".")
    if len(parts) != 3 or not secret or not parts[1].isdigit() or not is_version(parts[0]):
        return None
    if not hmac.compare_digest(sign(parts[0], secret, int(parts[1])), token) or int(parts[1]) < (now or time.time()):
        return None
    return parts[0]
