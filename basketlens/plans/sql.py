"""SQL text builders for the DuckDB oracle statements.

The oracle only has the base tables; each statement inlines the fixture
derivations and the feature table as CTEs.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from ..operators.binning import QUARTILE_LABELS, UNKNOWN
from ..sources.fixtures import CAMPAIGN_SQL, LINES_DIRTY_SQL, LINES_SQL
from ..sources.schemas import BIN_SOURCES, FEATURE_COLUMNS

FIXTURE_SQL = {"lines": LINES_SQL, "lines_dirty": LINES_DIRTY_SQL, "campaign": CAMPAIGN_SQL}


def statement(body: str, fixtures: Sequence[str] = (), ctes: Sequence[tuple[str, str]] = ()) -> str:
    need = set(fixtures)
    if "lines_dirty" in need:
        need.add("lines")
    parts = [(n, FIXTURE_SQL[n]) for n in ("lines", "lines_dirty", "campaign") if n in need]
    parts += list(ctes)
    if not parts:
        return body
    return "WITH " + ",\n".join(f"{n} AS ({s})" for n, s in parts) + "\n" + body


def rnd(expr: str, digits: int) -> str:
    """Same rounding as ``catalog.rounded``: offset keeps decimal midpoints off the boundary."""
    return f"round(({expr}) + {10.0 ** -(digits + 2)!r}, {digits})"


def select_list(columns: Sequence[str], rounding: Mapping[str, int] | None = None, prefix: str = "") -> str:
    rounding = rounding or {}
    out = []
    for c in columns:
        if c in rounding:
            out.append(f"{rnd(prefix + c, rounding[c])} AS {c}")
        else:
            out.append(f"{prefix}{c}")
    return ", ".join(out)


CUSTOMER_AGG_CTES = [
    ("cagg", """
SELECT CustomerID, min(InvoiceDate) AS first_purchase, max(InvoiceDate) AS last_purchase,
       coalesce(sum(Quantity * UnitPrice), 0) AS total_spending,
       count(DISTINCT InvoiceNo) AS num_orders, CAST(coalesce(sum(Quantity), 0) AS BIGINT) AS total_quantity,
       count(DISTINCT StockCode) AS product_diversity,
       sum(CASE WHEN Quantity < 0 THEN Quantity END) AS returned
FROM {src} GROUP BY CustomerID"""),
    ("cgmax", "SELECT max(InvoiceDate) AS gmax FROM {src}"),
    ("feat0", """
SELECT CustomerID, first_purchase, last_purchase, total_spending,
       CAST(num_orders AS BIGINT) AS num_orders, total_quantity,
       total_spending / nullif(num_orders, 0) AS avg_order_value,
       CAST(date_sub('day', last_purchase, gmax) AS BIGINT) AS recency,
       CAST(date_sub('day', first_purchase, last_purchase) AS BIGINT) AS customer_tenure,
       CAST(total_quantity AS DOUBLE) / nullif(num_orders, 0) AS avg_quantity_per_order,
       CAST(date_sub('day', first_purchase, last_purchase) AS DOUBLE) / nullif(num_orders, 0) AS order_frequency,
       CAST(product_diversity AS BIGINT) AS product_diversity,
       coalesce(CAST(abs(returned) AS DOUBLE) / nullif(CAST(total_quantity AS DOUBLE), 0), 0) AS return_rate
FROM cagg CROSS JOIN cgmax WHERE CustomerID IS NOT NULL"""),
]


def customer_agg_ctes(src: str = "lines") -> list[tuple[str, str]]:
    return [(n, s.format(src=src)) for n, s in CUSTOMER_AGG_CTES]


def quartile_bin_ctes(table: str, sources: Sequence[str]) -> tuple[list[tuple[str, str]], dict[str, str]]:
    """CTEs computing each source column's deduplicated inlier edges, plus a label expression per source."""
    ctes = []
    labels = {}
    for i, x in enumerate(sources):
        s, e = f"bs{i}", f"be{i}"
        ctes.append((s, f"SELECT quantile_cont({x}, 0.25) AS q1, quantile_cont({x}, 0.75) AS q3, "
                        f"min({x}) AS mn, max({x}) AS mx FROM {table}"))
        ctes.append((e, f"SELECT list_sort(list_distinct([min({x}), quantile_cont({x}, 0.25), "
                        f"quantile_cont({x}, 0.5), quantile_cont({x}, 0.75), max({x})])) AS ed "
                        f"FROM {table} CROSS JOIN {s} WHERE {s}.mn < {s}.mx AND "
                        f"{x} BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1)"))
        branches = [f"WHEN len({e}.ed) >= 2 AND {x} >= {e}.ed[1] AND {x} <= {e}.ed[2] THEN '{QUARTILE_LABELS[0]}'"]
        for k in range(2, 5):
            branches.append(f"WHEN len({e}.ed) >= {k + 1} AND {x} > {e}.ed[{k}] AND {x} <= {e}.ed[{k + 1}] "
                            f"THEN '{QUARTILE_LABELS[k - 1]}'")
        labels[x] = f"CASE {' '.join(branches)} ELSE '{UNKNOWN}' END"
    return ctes, labels


def features_ctes(src: str = "lines", name: str = "feat") -> list[tuple[str, str]]:
    """CTEs ending in ``name``: the full 19-column customer-feature table."""
    sources = list(dict.fromkeys(BIN_SOURCES.values()))
    bctes, labels = quartile_bin_ctes("feat0", sources)
    joins = " ".join(f"CROSS JOIN be{i}" for i in range(len(sources)))
    cols = []
    for c in FEATURE_COLUMNS:
        if c in BIN_SOURCES:
            cols.append(f"{labels[BIN_SOURCES[c]]} AS {c}")
        else:
            cols.append(f"feat0.{c}")
    body = f"SELECT {', '.join(cols)} FROM feat0 {joins}"
    return customer_agg_ctes(src) + bctes + [(name, body)]


def _poly_sql(coeffs, x: str) -> str:
    acc = repr(coeffs[-1])
    for a in reversed(coeffs[:-1]):
        acc = f"(({acc}) * ({x}) + {a!r})"
    return acc


def norm_ppf_sql(p: str) -> str:
    """SQL text of ``functions.columns.norm_ppf`` (same operations, same order)."""
    from ..functions import columns as C
    q = f"(({p}) - 0.5)"
    rc = f"(0.180625 - {q} * {q})"
    central = f"({q} * {_poly_sql(C._AS241_A, rc)} / {_poly_sql(C._AS241_B, rc)})"
    rt = f"sqrt(-ln(least({p}, 1.0 - ({p}))))"
    near, far = f"({rt} - 1.6)", f"({rt} - 5.0)"
    mag = (f"(CASE WHEN {rt} <= 5.0 THEN {_poly_sql(C._AS241_C, near)} / {_poly_sql(C._AS241_D, near)} "
           f"ELSE {_poly_sql(C._AS241_E, far)} / {_poly_sql(C._AS241_F, far)} END)")
    tail = f"(CASE WHEN {q} < 0 THEN -{mag} ELSE {mag} END)"
    return (f"(CASE WHEN ({p}) <= 0 OR ({p}) >= 1 THEN NULL WHEN abs({q}) <= 0.425 THEN {central} "
            f"ELSE {tail} END)")


def bin_levels_sql(bin_col: str) -> str:
    """SELECT of the level list of a bin column (labels its fitted edges produce, then 'Unknown').

    Needs the ``be{i}`` CTEs of ``features_ctes`` in scope.
    """
    sources = list(dict.fromkeys(BIN_SOURCES.values()))
    i = sources.index(BIN_SOURCES[bin_col])
    values = ", ".join(f"('{lv}', {k + 1})" for k, lv in enumerate(QUARTILE_LABELS))
    return (f"SELECT lv FROM (VALUES {values}) v(lv, k), be{i} WHERE k <= len(be{i}.ed) - 1 "
            f"UNION ALL SELECT '{UNKNOWN}'")
