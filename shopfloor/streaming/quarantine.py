"""Sales that wait for their dimension rows (J8 on a stream).

The referential checks drop a sale whose store, customer or product has no
current version. On a stream the version may land later than the sale, so such
rows are held and checked again; a full refresh, which sees both, keeps them.

Held rows lie in a versioned table. A micro-batch adds those of its own, and
takes up the held ones once a dimension has changed since they were last looked
at, or FAN batches have added some. Its manifest tells the folders as they were
before the last batch, so a retry starts from those. Rows without one of the
keys are not held: no dimension row can ever match them.

``begin_release`` notes a release before any of its rows are written, so one
that dies is done again, whole, before anything else looks at held rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import config as C
from ..sources.store import TableStore
from ..sources.versions import FAN, VersionedTable

WAITING = "silver.sales_waiting"
CHECKED = ("store_id", "customer_id", "product_id")


class Quarantine:
    def __init__(self, store: TableStore, table: VersionedTable | None = None):
        self.store = store
        self.table = table or store.versioned(WAITING)

    def dimensions(self, names: dict[str, str]) -> dict:
        """The version of each stored dimension; None: it has no versions."""
        tables = {e: self.store.versioned(n) for e, n in names.items()}
        return {e: t.manifest().version if t.exists() else None for e, t in tables.items()}

    def releasing(self) -> int | None:
        """The number of a release that was begun and not ended."""
        return self.table.manifest().info.get("releasing")

    def last_batch(self) -> int | None:
        return self.table.manifest().info.get("batch")

    def begin_release(self, dimensions: dict) -> int | None:
        """The number of a new release, if held rows may have found their rows."""
        held = self.table.manifest()
        if not held.runs.get("held") or not self._changed(held, dimensions):
            return None
        number = held.info.get("releases", 0) + 1
        self.table.commit(held, info={**held.info, "releasing": number})
        return number

    @staticmethod
    def _changed(held, dimensions: dict) -> bool:
        return None in dimensions.values() or held.info.get("dimensions") != dimensions

    def _before(self, held, batch_id: int | None) -> list[str]:
        """Folders held before this batch's first attempt; ``None``: a release."""
        folders = [f for f, _ in held.runs.get("held", [])]
        last = held.info.get("batch")
        if batch_id is None or last is None or batch_id > last:
            return folders
        if batch_id < last or held.info.get("before") is None:
            if held.info.get("ever"):
                raise ValueError(f"rows of batch {batch_id} may be released by now; only a full refresh can replay it")
            return folders
        return held.info["before"]

    def due(self, batch_id: int | None, dimensions: dict, schema) -> DataFrame | None:
        """Held rows that this batch has to check again; ``None``: none are."""
        held = self.table.manifest()
        before = self._before(held, batch_id)
        again = batch_id is None or batch_id == held.info.get("batch") or len(before) >= FAN
        return self.table.read(before, schema) if before and (again or self._changed(held, dimensions)) else None

    def hold(self, orphans: DataFrame, batch_id: int | None, dimensions: dict, checked_again: bool) -> None:
        """Keep this batch's orphans, in place of the rows it checked again."""
        held = self.table.manifest()
        before = self._before(held, batch_id)
        folder = self.table.new_folder("held")
        keyed = orphans
        for key in CHECKED:
            keyed = keyed.where(F.col(key).isNotNull())
        self.table.write(keyed, folder, [])
        some = not self.table.read([folder], orphans.schema).isEmpty()
        now = ([] if checked_again else before) + ([folder] if some else [])
        info = {**held.info, "dimensions": dimensions if checked_again or not before else held.info.get("dimensions"),
                "ever": bool(held.info.get("ever") or some)}
        if batch_id is None:
            info |= {"releases": held.info["releasing"], "releasing": None, "before": None}
        else:
            info |= {"batch": max(batch_id, held.info.get("batch", batch_id)), "before": before}
        self.table.commit(held, runs={"held": [[f, 0] for f in now]}, info=info)

    def waiting(self, schema) -> DataFrame | None:
        """The rows held now."""
        return self.table.read([f for f, _ in self.table.manifest().runs.get("held", [])], schema)


def flagged(sales: DataFrame, dims: dict[str, DataFrame], flag: str) -> DataFrame:
    """``sales`` with ``flag``: whether all three dimensions hold a current
    version (J1-J3), in one pass that also keeps the orphans."""
    out, found = sales, F.lit(True)
    for entity in ("stores", "customers", "products"):
        key, has = C.KEYS[entity], f"_has_{entity}"
        out = out.join(dims[entity].select(key, F.lit(True).alias(has)), key, "left")
        found = found & F.col(has).isNotNull()
    return out.select(*sales.columns, found.alias(flag))
