"""Bronze to marts: builds each model once, on demand, from the ones it refers to."""

from __future__ import annotations

from collections import Counter
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from datetime import date
from functools import cached_property

from pyspark.sql import DataFrame

from courierlake.plans import gold, marts
from courierlake.plans.silver import SILVER
from courierlake.session import materialize


#: What each model reads. Silver tables read bronze.
READS = {
    "fct_orders": ("silver_orders",),
    "fct_payments": ("silver_payments",),
    "fct_delivery": ("silver_delivery",),
    "fct_reviews": ("silver_reviews",),
    "fct_billing": ("silver_billing",),
    "dim_customers": ("silver_customers", "silver_users"),
    "dim_restaurants": ("silver_restaurants", "silver_billing"),
    "dim_drivers": ("silver_drivers",),
    "dim_promotions": ("silver_promotions",),
    "dim_users": ("silver_users",),
    "star_orders": ("silver_orders", "silver_payments", "dim_customers", "dim_restaurants"),
    "mart_revenue": ("star_orders",),
    "revenue_growth_by_day": ("star_orders",),
    "mart_subscription": ("fct_billing", "dim_restaurants"),
}


def shared_nodes(*models: str) -> set[str]:
    """What two or more models read in a run that builds the given ones."""
    readers: Counter[str] = Counter()
    todo, seen = list(models), set()
    while todo:
        model = todo.pop()
        if model not in seen:
            seen.add(model)
            readers.update(READS.get(model, ()))
            todo += READS.get(model, ())
    return {node for node, n in readers.items() if n > 1}


class Pipeline:
    """The model graph over a set of bronze tables.

    ``bronze(topic)`` returns a bronze table. Silver tables are plans, evaluated inside
    whatever reads them; a run that builds several models should set ``store_silver``, so
    that each is cleaned and deduplicated once and its readers scan only their columns.
    Without it only the tables that two models of a run read are stored; ``share`` names the run.
    Dimensions that a mart joins are always written out first: the mart then knows their
    true size, and two readers do not compute them twice.
    """

    def __init__(
        self, bronze: Callable[[str], DataFrame], as_of: date, store_silver: bool = False
    ):
        self._bronze = bronze
        self.as_of = as_of
        self.store_silver = store_silver
        self._silver: dict[str, DataFrame] = {}
        self._shared: set[str] = set()

    def share(self, *models: str) -> Pipeline:
        """Build these models in one run: a silver table, or the star, that several of them read is stored."""
        self._shared |= shared_nodes(*models)
        return self

    def bronze(self, topic: str) -> DataFrame:
        return self._bronze(topic)

    def silver(self, topic: str) -> DataFrame:
        if topic not in self._silver:
            table = SILVER[topic](self._bronze(topic), self.as_of)
            store = self.store_silver or f"silver_{topic}" in self._shared
            self._silver[topic] = materialize(table, f"silver_{topic}") if store else table
        return self._silver[topic]

    @cached_property
    def fct_orders(self) -> DataFrame:
        return gold.fct_orders(self.silver("orders"))

    @cached_property
    def fct_payments(self) -> DataFrame:
        return gold.fct_payments(self.silver("payments"))

    @cached_property
    def fct_delivery(self) -> DataFrame:
        return gold.fct_delivery(self.silver("delivery"))

    @cached_property
    def fct_reviews(self) -> DataFrame:
        return gold.fct_reviews(self.silver("reviews"))

    @cached_property
    def fct_billing(self) -> DataFrame:
        return gold.fct_billing(self.silver("billing"))

    @cached_property
    def dim_customers(self) -> DataFrame:
        return gold.dim_customers(self.silver("customers"), self.silver("users"), self.as_of)

    @cached_property
    def dim_restaurants(self) -> DataFrame:
        return gold.dim_restaurants(self.silver("restaurants"), self.silver("billing"))

    @cached_property
    def dim_drivers(self) -> DataFrame:
        return gold.dim_drivers(self.silver("drivers"))

    @cached_property
    def dim_promotions(self) -> DataFrame:
        return gold.dim_promotions(self.silver("promotions"))

    @cached_property
    def dim_users(self) -> DataFrame:
        return gold.dim_users(self.silver("users"))

    @cached_property
    def stored_customers(self) -> DataFrame:
        return materialize(self.dim_customers, "dim_customers")

    @cached_property
    def stored_restaurants(self) -> DataFrame:
        return materialize(self.dim_restaurants, "dim_restaurants")

    def _store_dimensions(self) -> None:
        """Both dimensions of the star at once: each alone leaves most of a cluster idle."""
        with ThreadPoolExecutor(2) as pool:
            list(pool.map(lambda name: getattr(self, name), ("stored_customers", "stored_restaurants")))

    @cached_property
    def star_orders(self) -> DataFrame:
        self._store_dimensions()
        star = marts.star_orders(
            gold.fct_orders(self.silver("orders"), with_id=True),
            gold.fct_payments(self.silver("payments"), with_id=True),
            self.stored_customers,
            self.stored_restaurants,
            key="order_id",
        )
        return materialize(star, "star_orders") if "star_orders" in self._shared else star

    @cached_property
    def mart_revenue(self) -> DataFrame:
        return marts.mart_revenue(self.star_orders)

    @cached_property
    def revenue_growth_by_day(self) -> DataFrame:
        return marts.revenue_growth_by_day(self.star_orders)

    @cached_property
    def mart_subscription(self) -> DataFrame:
        self.share("mart_subscription")
        return marts.mart_subscription(self.fct_billing, self.stored_restaurants)
