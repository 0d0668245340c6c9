"""Settings of one deployment."""

from __future__ import annotations

from dataclasses import dataclass


@dataclass(frozen=True)
class EngineConfig:
    """Where tables live and which feed rows belong to them.

    ``root`` is a folder every executor can reach; each table is one folder below it.
    """

    root: str
    # fixed values: public balancing-authority codes of the demand feed, the mark of its demand
    # rows, and the number of the public weather station that stands for each authority
    respondent: str | tuple[str, ...] = "ERCO"
    feed_type: str = "D"
    station: str | tuple[str, ...] = "72243012960"
    history_days: int = 365
    horizon_hours: int = 48
    # Read each landed file once and keep broken ones apart, instead of the whole folder each night.
    ledger: bool = False

    @property
    def stations(self) -> dict[str, str]:
        """The station of each respondent; one station may serve several, or all."""
        names = (self.respondent,) if isinstance(self.respondent, str) else self.respondent
        if isinstance(self.station, str):
            return dict.fromkeys(names, self.station)
        return dict(zip(names, self.station, strict=True))
