"""The upsert and the latest-state reductions row by row, in plain Python.

Used only to check the DataFrame operators on small inputs.
"""

from __future__ import annotations

from collections import defaultdict
from hashlib import md5

NULL_LIKE = {"", "none", "null", "unknown", "n/a"}
CATALOG_ID = 12


def digest(text: str) -> str:
    return md5(text.encode()).hexdigest()


def key_of(ref: str | None) -> str:
    return digest(f"catalog|{'' if ref is None else ref}|")


def hash_of(ref: str | None) -> str:
    parts = [str(p) for p in ("catalog", ref, None) if str(p).strip().lower() not in NULL_LIKE]
    return digest(str(parts))


def is_relevant(event: dict) -> bool:
    automatic = event["op_type"] == "I" and event["link_origin"] == "A"
    return event["order_id"] is not None and event["op_type"] in ("I", "D") and not automatic


class Model:
    """Five tables and one method that applies a batch to them."""

    def __init__(self, orders, sources, customers) -> None:
        self.orders, self.sources = orders, sources
        self.customers = list(customers)  # (id, ref, source id)
        self.backfilled: dict[str, tuple] = {}
        self.candidates: dict[tuple, list] = {}
        self.links: dict[tuple, tuple] = {}
        self.candidates_history: list = []
        self.links_history: list = []

    def apply(self, batch: list[dict]) -> None:
        batch = [e for e in batch if is_relevant(e)]
        first: dict[str, int] = {}
        for event in batch:
            ref = event["customer_ref"]
            if ref is not None:
                first[ref] = min(first.get(ref, event["op_ts"] // 1000), event["op_ts"] // 1000)
        for ref, second in first.items():
            if not any(s == CATALOG_ID and i == key_of(ref) for i, _, s in self.customers):
                self.customers.append((key_of(ref), ref, CATALOG_ID))
                self.backfilled[ref] = (key_of(ref), second)

        stage: dict[tuple, tuple] = {}
        for event in batch:
            for order_id, source in self.orders:
                if order_id != event["order_id"] or "operational" not in self.sources[source]:
                    continue
                matches = [
                    i for i, ref, s in self.customers
                    if s == CATALOG_ID and ref == event["customer_ref"] and ref is not None
                ] or [None]
                for customer in matches:
                    row = (source, order_id, customer, event["customer_ref"],
                           event["op_ts"] // 1000, event["op_type"])
                    place = (event["op_ts"], event["kafka_partition"], event["kafka_offset"])
                    stage[row] = max(stage.get(row, place), place)

        fresh = defaultdict(list)
        for source, order_id, customer, _, second, op in stage:
            self.links_history.append((source, order_id, customer, op, second))
            if op == "I":
                fresh[source, order_id].append((customer, second))
                self.candidates_history.append((source, order_id, customer, second))
        self.candidates.update(fresh)

        def replay_key(item):
            (_, _, customer, _, second, op), place = item
            return second, {"D": 1, "I": 2}[op], place, customer or ""

        for (source, order_id, customer, _, second, op), _ in sorted(stage.items(), key=replay_key):
            self.links.pop((source, order_id), None)
            if op == "I":
                self.links[source, order_id] = (customer, second)
