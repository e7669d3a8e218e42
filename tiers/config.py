"""Environment configuration and name resolution (dev / prod are two schemas, same code)."""

from __future__ import annotations

from dataclasses import dataclass, replace

# Table names of the four layers and the landing folder name.
BRONZE = "bronze_orders"
SILVER = "silver_orders"
GOLD_SALES = "gold_sales_by_region"
GOLD_PRODUCTS = "gold_top_products"
LAYER_TABLES = (BRONZE, SILVER, GOLD_SALES, GOLD_PRODUCTS)
LANDING_FOLDER = "raw_data"
DEFAULT_RUN_DATE = "2024-03-31"


@dataclass(frozen=True)
class Env:
    """One environment: where the landing files are and which schema holds the tables.

    ``catalog`` defaults to Spark's session catalog, whose namespaces are single-part.
    ``fmt`` is the table format (``parquet`` everywhere; ``delta`` where its jar is on
    the classpath, which gives atomic overwrites).  ``landing_root`` is any shared
    Hadoop-FS path (no default: a machine-local folder would not be visible to
    executors); the landing folder is ``{landing_root}/{catalog}/{schema}/raw_data``
    unless ``landing_path`` is given.  ``schema_location`` places the schema's managed tables
    (default: the warehouse dir).  ``swap_overwrite`` chooses how layer tables are
    replaced (``None``: a new version folder and one catalog change for non-Delta formats; see
    ``tiers.sources.tables.overwrite_table``).  ``silver_cluster_by`` sorts each silver
    file by these columns before the write (a local sort, no shuffle): with ``status``
    clustered, the gold scans' pushed ``status = 'completed'`` skips the row groups of
    other statuses instead of reading them.  Row order is not part of the table's contract.
    ``skip_null_keys`` keeps rows without an order id, which the rules drop anyway, out of the
    dedup's shuffle (same rows, same counts).
    """

    schema: str = "sales_lab"
    catalog: str = "spark_catalog"
    landing_root: str | None = None
    landing_path: str | None = None
    fmt: str = "parquet"
    run_date: str = DEFAULT_RUN_DATE
    schema_location: str | None = None
    path_glob: str | None = None
    swap_overwrite: bool | None = None
    silver_cluster_by: tuple[str, ...] = ("status",)
    skip_null_keys: bool = True

    def table(self, name: str) -> str:
        return f"{self.catalog}.{self.schema}.{name}"

    @property
    def namespace(self) -> str:
        return f"{self.catalog}.{self.schema}"

    @property
    def landing(self) -> str:
        if self.landing_path:
            return self.landing_path
        if not self.landing_root:
            raise ValueError("Env needs landing_root or landing_path (a shared filesystem path)")
        return f"{self.landing_root.rstrip('/')}/{self.catalog}/{self.schema}/{LANDING_FOLDER}"

    def with_schema(self, schema: str) -> "Env":
        """The twin environment (e.g. dev → prod): same settings, other schema."""
        return replace(self, schema=schema)

    def with_(self, **changes) -> "Env":
        return replace(self, **changes)
