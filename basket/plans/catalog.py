"""The query catalogue: the 18 named queries, their groups, parameters and bounds.

``run(tables, key, **params)`` validates parameters against the bounds and
returns the lazy result; the two k-means entries fit their model (once for equal
parameters over the same tables) before they return.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field
from typing import Any

from pyspark.sql import DataFrame

from basket.plans import activity as A
from basket.plans import departments as D
from basket.plans import overview as O
from basket.plans import products as P
from basket.plans import segments as G
from basket.sources.tables import Tables


@dataclass(frozen=True)
class Param:
    name: str
    default: Any
    lo: float | None = None
    hi: float | None = None
    optional: bool = False
    kind: type = int
    choices: tuple[str, ...] = ()

    def check(self, value: Any) -> Any:
        if value is None:
            if self.optional:
                return None
            raise ValueError(f"{self.name} is required")
        if self.choices and value not in self.choices:
            raise ValueError(f"{self.name}={value!r} is not one of {self.choices}")
        try:
            value = self.kind(value)
        except (TypeError, ValueError):
            raise ValueError(f"{self.name}={value!r} is not a {self.kind.__name__}") from None
        if self.lo is not None and value < self.lo:
            raise ValueError(f"{self.name}={value} is below {self.lo}")
        if self.hi is not None and value > self.hi:
            raise ValueError(f"{self.name}={value} is above {self.hi}")
        return value


@dataclass(frozen=True)
class Entry:
    key: str
    label: str
    group: str
    fn: Callable[..., DataFrame]
    params: tuple[Param, ...] = field(default_factory=tuple)

    @property
    def ranked(self) -> bool:
        """The result is in rank order already."""
        return self.key not in ("kmeans_user_clusters",)

    @property
    def needs_n(self) -> bool:
        return any(p.name == "n" for p in self.params)

    @property
    def needs_min_count(self) -> bool:
        return any(p.name == "min_count" for p in self.params)


# Parameter bounds of the query surface.
N = Param("n", 10, 1, 100)
MIN_COUNT = Param("min_count", 200, 1, 1_000_000)
K = Param("k", 5, 2, 20)
SEED = Param("seed", 42)
CLUSTER = Param("cluster", None, 0, 19, optional=True)
LIMIT = Param("limit", 1000, 1, 50_000)
FIT = (
    K,
    SEED,
    Param("min_orders", 5, 1, 1_000_000),
    Param("sample_fraction", 1.0, 0.0, 1.0, kind=float),
    Param("user_fraction", 1.0, 0.0, 1.0, kind=float),
    Param("max_users", None, 1, 1_000_000_000_000, optional=True),
    Param("assign", "train", kind=str, choices=("train", "active", "all")),
)

# Result-size caps per query when materialised as records (to_records).
DEFAULT_LIMIT = 1000
DEPARTMENT_LIMIT = 200


def _e(key, label, group, fn, *params):
    return Entry(key, label, group, fn, tuple(params))


CATALOG: dict[str, Entry] = {
    e.key: e
    for e in [
        _e(
            "kpi",
            "KPI overview",
            "KPI",
            lambda t: O.kpi_overview_bitmaps(t.orders, t.order_items) if t.raw else O.kpi_overview(t.orders, t.item_parts),
        ),
        _e("top_products", "Top products", "Products", lambda t, n: P.top_products(t.order_items, t.products, n), N),
        _e("reorder_rate_global", "Global reorder rate", "Products", lambda t: O.reorder_rate_global(t.order_items)),
        _e(
            "top_reordered_products",
            "Top reordered products",
            "Products",
            lambda t, n, min_count: P.top_reordered_products(t.order_items, t.products, n, min_count),
            N,
            MIN_COUNT,
        ),
        _e(
            "sales_by_department",
            "Sales by department",
            "Departments",
            lambda t: D.sales_by_department(t.order_items, t.products, t.departments),
        ),
        _e(
            "reorder_rate_by_department",
            "Reorder rate by department",
            "Departments",
            lambda t: D.reorder_rate_by_department(t.order_items, t.products, t.departments),
        ),
        _e("orders_by_dow", "Orders by weekday", "Time", lambda t: A.orders_by_dow(t.orders)),
        _e("orders_by_hour", "Orders by hour", "Time", lambda t: A.orders_by_hour(t.orders)),
        _e("avg_items_by_dow", "Basket size by weekday", "Time", lambda t: A.avg_items_by_dow(t.orders, t.item_parts)),
        _e("basket_size_buckets", "Basket size buckets", "Customers", lambda t: A.basket_size_buckets(t.item_parts)),
        _e("avg_orders_per_user", "Orders per user", "Customers", lambda t: A.avg_orders_per_user(t.orders)),
        _e("top_users_by_orders", "Top users by orders", "Customers", lambda t, n: A.top_users_by_orders(t.orders, n), N),
        _e("orders_count_by_eval_set", "Orders per split", "Dataset", lambda t: A.orders_by_eval_set(t.orders)),
        _e("items_sold_by_eval_set", "Items per split", "Dataset", lambda t: A.items_by_eval_set(t.order_items)),
        _e(
            "avg_items_per_order_by_eval_set",
            "Basket size per split",
            "Dataset",
            lambda t: A.avg_items_by_eval_set(t.item_parts),
        ),
        _e("reorder_rate_by_eval_set", "Reorder rate per split", "Dataset", lambda t: A.reorder_rate_by_eval_set(t.order_items)),
        _e(
            "kmeans_user_clusters",
            "User clusters",
            "Customers",
            lambda t, **p: G.kmeans_user_clusters(t.orders, t.item_parts, t.products, **p),
            *FIT,
            CLUSTER,
        ),
        _e(
            "kmeans_user_cluster_profile",
            "User cluster profile",
            "Customers",
            lambda t, **p: G.kmeans_cluster_profile(t.orders, t.item_parts, t.products, **p),
            *FIT,
        ),
    ]
}

GROUPS = ("KPI", "Products", "Departments", "Time", "Customers", "Dataset")


def result_limit(key: str) -> int:
    if key in ("sales_by_department", "reorder_rate_by_department", "kmeans_user_cluster_profile"):
        return DEPARTMENT_LIMIT
    return DEFAULT_LIMIT


def arguments(key: str, **params: Any) -> dict[str, Any]:
    """All parameters of the query, checked, with its defaults for those not given."""
    try:
        entry = CATALOG[key]
    except KeyError:
        raise ValueError(f"unknown query {key!r}; known: {sorted(CATALOG)}") from None
    extra = set(params) - {p.name for p in entry.params}
    if extra:
        raise ValueError(f"{key} takes no parameter(s) {sorted(extra)}")
    return {p.name: p.check(params.get(p.name, p.default)) for p in entry.params}


def run(tables: Tables, key: str, **params: Any) -> DataFrame:
    args = arguments(key, **params)
    return CATALOG[key].fn(tables, **args)
