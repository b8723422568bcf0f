"""Job parameters of a mirror run."""

from __future__ import annotations

from dataclasses import dataclass

LOG_KEYS = ("topic", "part")

MIB = 1024 * 1024


@dataclass(frozen=True)
class MirrorSettings:
    """Settings of one mirror job; the defaults are the limits the mirror ships with."""

    source: str = "sync_0"
    target: str | None = None
    client_id: str = "sync"
    starting: str = "earliest"  # "earliest", "latest" or a timestamp text
    force_start: bool = False
    on_out_of_range: str = "reset"  # "reset" or "fail"
    max_behind: int = 2**63 - 1
    max_bytes: int = MIB
    batch_rows: int = 100
    limit_per_partition: int = 200
    refresh_seconds: int = 60
    idle_minutes: int = 2
    idle_polls: int = 10
    volume_limit_bytes: int = 10 * MIB
    volume_window: str = "60 seconds"

    def __post_init__(self) -> None:
        if self.on_out_of_range not in ("reset", "fail"):
            raise ValueError(f"on_out_of_range must be 'reset' or 'fail', not {self.on_out_of_range!r}")
        for name in ("max_bytes", "batch_rows", "refresh_seconds", "idle_minutes"):
            if getattr(self, name) <= 0:
                raise ValueError(f"{name} must be positive")

    @property
    def idle_limit_seconds(self) -> int:
        """A partition is reported idle after this long without data."""
        return self.idle_polls * self.idle_minutes * 60
