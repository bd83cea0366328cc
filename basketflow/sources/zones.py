"""Where each zone lives. A table is a folder below its zone."""

from __future__ import annotations

import hashlib
from dataclasses import dataclass


@dataclass(frozen=True)
class Zones:
    raw: str
    clean: str
    curated: str
    consumption: str
    quarantine: str
    # Where raw tables lie in the raw zone; notifications name keys below it.
    prefix: str = "data/"

    @classmethod
    def under(cls, root: str, prefix: str = "data/") -> "Zones":
        root = root.rstrip("/")
        zones = (f"{root}/{zone}" for zone in ("raw", "clean", "curated", "consumption", "quarantine"))
        return cls(*zones, prefix)

    def raw_table(self, table: str) -> str:
        """One CSV object, or a folder of them under the same name."""
        return f"{self.raw}/{self.prefix}{table}.csv"

    def clean_table(self, table: str) -> str:
        return f"{self.clean}/{table}"

    def curated_table(self, table: str) -> str:
        return f"{self.curated}/{table}"

    def history_log(self) -> str:
        """What is known of the loads of history, and their sums."""
        return f"{self.curated}/_history"

    def ml_dataset(self) -> str:
        return f"{self.curated}/ml_dataset"

    def rejects(self, table: str) -> str:
        return f"{self.quarantine}/table={table}"

    def orphans(self, reference: str) -> str:
        return f"{self.quarantine}/orphans/{reference}"

    def bookmark(self, table: str) -> str:
        """Kept per raw path: another raw folder is another history."""
        raw = hashlib.sha256(self.raw_table(table).encode()).hexdigest()[:16]
        return f"{self.clean}/_bookmarks/{table}/{raw}"

    def predictions(self) -> str:
        return f"{self.consumption}/predictions"
