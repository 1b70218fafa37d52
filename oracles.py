"""DuckDB SQL for every query that SQL can express.

The SQL derives the same sales table from the star-schema views and states each
report independently of the Spark code. Division is guarded with NULLIF, sort
keys end with the group keys, and integer results are cast to Spark's widths.
"""

from __future__ import annotations

RAW = """
raw AS (
    SELECT o.l_orderkey AS order_id,
           CASE WHEN o.l_orderkey % 97 = 0 THEN 'bad-date'
                ELSE strftime(d.o_orderdate + INTERVAL 10 YEAR, '%m-%d-%y') END AS order_date,
           p.p_type AS category, p.p_brand AS sub_category, p.p_name AS product_name,
           r.r_name AS region, n.n_name AS state,
           CASE WHEN o.l_partkey % 101 = 0 THEN NULL ELSE CAST(o.l_quantity AS INTEGER) END AS quantity,
           CASE WHEN o.l_partkey % 89 = 0 THEN 0.0::DOUBLE
                ELSE o.l_extendedprice / NULLIF(o.l_quantity, 0) END AS unit_price,
           CAST(CASE WHEN o.l_orderkey % 83 = 0 THEN 0
                ELSE CAST(o.l_extendedprice AS DECIMAL(12,2)) END AS DECIMAL(12,2)) AS revenue,
           CAST(CASE WHEN o.l_orderkey % 83 = 0 THEN 0
                ELSE CAST(o.l_extendedprice AS DECIMAL(12,2)) * (1 - CAST(o.l_discount AS DECIMAL(4,2)))
                     - CAST(0.5 AS DECIMAL(2,1)) * CAST(o.l_quantity AS INTEGER)
                       * CAST(p.p_retailprice AS DECIMAL(12,2)) END AS DECIMAL(18,4)) AS profit
    FROM lineitem o
    JOIN orders d ON d.o_orderkey = o.l_orderkey
    JOIN part p ON p.p_partkey = o.l_partkey
    JOIN customer c ON c.c_custkey = d.o_custkey
    JOIN nation n ON n.n_nationkey = c.c_nationkey
    JOIN region r ON r.r_regionkey = n.n_regionkey
    CROSS JOIN range(2) AS copy(i)
    WHERE copy.i = 0 OR o.l_orderkey % 50 = 0
)"""

TYPED = """
typed AS (
    SELECT *, CAST(try_strptime(order_date, '%m-%d-%y') AS DATE) AS order_date_parsed,
           CAST(year(try_strptime(order_date, '%m-%d-%y')) AS INTEGER) AS order_year,
           CAST(month(try_strptime(order_date, '%m-%d-%y')) AS INTEGER) AS order_month,
           strftime(try_strptime(order_date, '%m-%d-%y'), '%Y-%m') AS order_year_month
    FROM raw
)"""

VALID = """order_id IS NOT NULL AND order_date_parsed IS NOT NULL AND category IS NOT NULL
    AND sub_category IS NOT NULL AND product_name IS NOT NULL AND region IS NOT NULL
    AND state IS NOT NULL AND quantity > 0 AND unit_price > 0 AND revenue >= 0 AND profit >= 0"""

MARGIN = "round(profit::DOUBLE / NULLIF(revenue::DOUBLE, 0) * 100, 2)"

CLEAN = f"""
clean AS (
    SELECT *, {MARGIN} AS profit_margin_pct
    FROM (SELECT DISTINCT * FROM typed) t WHERE {VALID}
)"""

ON_RAW = f"WITH {RAW}"
ON_TYPED = f"WITH {RAW}, {TYPED}"
ON_CLEAN = f"WITH {RAW}, {TYPED}, {CLEAN}"

COLUMNS = (
    "order_id, order_date, category, sub_category, product_name, region, state, "
    "quantity, unit_price, revenue, profit"
)
MEASURES = ("quantity", "unit_price", "revenue", "profit", "profit_margin_pct")


def _r2(value: str, name: str) -> str:
    # Adding zero turns a rounded -0.0 into 0.0.
    return f"CAST(round({value}, 2) AS DOUBLE) + 0.0 AS {name}"


def _kpis(keys: str, source: str = "clean") -> str:
    """Unrounded sums and margin per group, as g(keys, n, qty, rev, prof, m)."""
    return f"""g AS (
    SELECT {keys}, COUNT(*) AS n, CAST(SUM(quantity) AS BIGINT) AS qty,
           SUM(revenue) AS rev, SUM(profit) AS prof,
           SUM(profit)::DOUBLE / NULLIF(SUM(revenue)::DOUBLE, 0) * 100 AS m
    FROM {source} GROUP BY ALL
)"""


MONEY = f"{_r2('rev', 'total_revenue')}, {_r2('prof', 'total_profit')}"
MONEY_MARGIN = f"{MONEY}, {_r2('m', 'profit_margin_pct')}"

SHARES = ", ".join(
    f"CAST(round({c}::DOUBLE / (SELECT SUM({c})::DOUBLE FROM g) * 100, 2) AS DOUBLE) AS {name}"
    for c, name in (("rev", "revenue_share_pct"), ("prof", "profit_share_pct"))
)
RANKS = ", ".join(
    f"rank() OVER (ORDER BY {c} DESC NULLS LAST) AS {name}_rank"
    for c, name in (("rev", "revenue"), ("prof", "profit"), ("m", "margin"))
)
PER_ORDER = (
    f"{_r2('rev::DOUBLE / n', 'avg_order_value')}, {_r2('prof::DOUBLE / n', 'profit_per_order')}"
)


def _overview(key: str, columns: str, source: str = "clean") -> str:
    return f"{ON_CLEAN}, {_kpis(key, source)} SELECT {key.split(' AS ')[-1]}, {columns} FROM g"


def _tier(low: int, high: int) -> str:
    return (
        f"CASE WHEN unit_price < {low} THEN 'Budget (<{low})' "
        f"WHEN unit_price < {high} THEN 'Mid-Range ({low}-{high})' ELSE 'Premium ({high}+)' END"
    )


def _counts(cols: tuple[str, ...], source: str) -> str:
    return " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, {c}::VARCHAR AS value, COUNT(*) AS row_count FROM {source} GROUP BY {c}"
        for c in cols
    )


def _bucket(*values: str) -> str:
    """Sampling bucket of a row: the beginning of an MD5, in millionths."""
    return f"(('0x' || left(md5(concat_ws('|', {', '.join(values)})), 8))::BIGINT % 1000000)"


SPLIT = (
    f"CASE WHEN {_bucket("'split 42'", 'order_id', 'product_name', 'state', 'quantity')} < 800000 "
    "THEN 'train' ELSE 'test' END"
)


def _by_measure(template: str) -> str:
    return " UNION ALL ".join(template.format(c=c) for c in MEASURES)


# Majority category per region, ties to the smaller name.
DOMINANT = """ranked AS (
    SELECT region, category, COUNT(*) AS cnt,
           row_number() OVER (PARTITION BY region ORDER BY COUNT(*) DESC, category) AS place
    FROM clean GROUP BY region, category
)"""

PROFILE = """profile AS (
    SELECT region, COUNT(*) AS order_count,
           round(avg(revenue::DOUBLE), 2) AS avg_revenue, round(avg(profit::DOUBLE), 2) AS avg_profit,
           round(avg(quantity::DOUBLE), 2) AS avg_quantity, round(avg(unit_price), 2) AS avg_unit_price
    FROM clean GROUP BY region
)"""

LABELS = """labels_ AS (
    SELECT column_name, label, row_count,
           row_number() OVER (PARTITION BY column_name ORDER BY row_count DESC, label) - 1 AS place
    FROM (SELECT 'category' AS column_name, category AS label, COUNT(*) AS row_count
          FROM clean GROUP BY category
          UNION ALL SELECT 'sub_category', sub_category, COUNT(*) FROM clean GROUP BY sub_category
          UNION ALL SELECT 'region', region, COUNT(*) FROM clean GROUP BY region)
)"""

SCHEMA = (
    ("order_id", "bigint"),
    ("order_date", "string"),
    ("category", "string"),
    ("sub_category", "string"),
    ("product_name", "string"),
    ("region", "string"),
    ("state", "string"),
    ("quantity", "int"),
    ("unit_price", "double"),
    ("revenue", "decimal(12,2)"),
    ("profit", "decimal(18,4)"),
    ("order_date_parsed", "date"),
    ("order_year", "int"),
    ("order_month", "int"),
    ("order_year_month", "string"),
)


def _text_columns() -> str:
    money = "CAST(revenue AS DOUBLE) AS revenue, CAST(profit AS DOUBLE) AS profit"
    return COLUMNS.replace("revenue, profit", money)


def _cluster_sql(complete: str) -> dict[str, str]:
    """Lloyd's steps as a recursive query, and what is read off their clusters."""
    features = ("revenue", "profit", "quantity", "unit_price", "profit_margin_pct")
    z = range(1, len(features) + 1)
    scores = ", ".join(
        f"coalesce(round(({c}::DOUBLE - avg({c}::DOUBLE) OVER ()) / stddev_samp({c}::DOUBLE) OVER () * 1000000), 0)::BIGINT AS z{i}"
        for i, c in zip(z, features)
    )
    every = ", ".join(f"z{i}" for i in z)
    gap = " + ".join(f"(z{i}::DOUBLE - c{i}) * (z{i}::DOUBLE - c{i})" for i in z)
    means = ", ".join(f"coalesce(m{i}, c{i}) AS c{i}" for i in z)
    sums = ", ".join(f"sum(z{i})::DOUBLE / count(*)::DOUBLE AS m{i}" for i in z)
    base = f"""{ON_CLEAN.replace('WITH ', 'WITH RECURSIVE ', 1)}, {complete},
        points AS (SELECT *, row_number() OVER () AS id FROM (SELECT *, {scores} FROM complete)),
        first_ AS (SELECT {every}, row_number() OVER (ORDER BY md5(concat_ws('|', {every}))) - 1 AS cluster
                   FROM (SELECT DISTINCT {every} FROM points)),
        steps AS (
            SELECT 0 AS step, k::BIGINT AS k, cluster, {', '.join(f'z{i}::DOUBLE AS c{i}' for i in z)}
            FROM first_, range(2, 9) t(k) WHERE cluster < k AND cluster < 8
            UNION ALL
            SELECT step, k, cluster, {means} FROM (SELECT step + 1 AS step, k, cluster, {', '.join(f'c{i}' for i in z)} FROM steps WHERE step < 20)
            LEFT JOIN (SELECT k, best.cluster AS cluster, {sums}
                       FROM (SELECT k, id, min({{'d': {gap}, 'cluster': cluster}}) AS best, {', '.join(f'any_value(z{i}) AS z{i}' for i in z)}
                             FROM points, steps WHERE step < 20 GROUP BY k, id) GROUP BY ALL) USING (k, cluster)
        ),
        centres AS (SELECT * FROM steps WHERE step = 20),
        placed AS (SELECT k, id, min({{'d': {gap}, 'cluster': cluster}}) AS best FROM points, centres GROUP BY k, id),
        clustered AS (SELECT p.*, best.cluster::INTEGER AS prediction FROM points p JOIN placed USING (id) WHERE k = 4)"""

    def profile(margin: str) -> str:
        named = {"avg_revenue": "revenue", "avg_profit": "profit", "avg_quantity": "quantity",
                 "avg_unit_price": "unit_price", margin: "profit_margin_pct"}
        return ", ".join([f"round(avg({c}::DOUBLE), 2) AS {out}" for out, c in named.items()] + ["count(*) AS order_count"])

    numbers = ", ".join(f"{c}::DOUBLE AS {c}" for c in MEASURES)
    squares = " + ".join(f"z{i} / 1e6::DOUBLE * (z{i} / 1e6::DOUBLE)" for i in z)
    dot = " + ".join(f"z{i} / 1e6::DOUBLE * s{i}" for i in z)
    pairs = [(i, j) for i in z for j in z]
    spread = ", ".join(
        f"covar_samp(z{i} / 1e6::DOUBLE, z{j} / 1e6::DOUBLE) AS m{i}{j}" for i, j in pairs
    )

    def power(name: str, matrix: str) -> str:
        """Power iteration: the leading unit vector of a symmetric matrix of one row."""
        product = ", ".join(" + ".join(f"m{i}{j} * v{j}" for j in z) + f" AS w{i}" for i in z)
        size = "sqrt(" + " + ".join(f"w{i} * w{i}" for i in z) + ")"
        start = ", ".join(f"{0.3 + 0.1 * i}::DOUBLE AS v{i}" for i in z)
        return f"""{name}_ AS (SELECT 0 AS step, {start} UNION ALL
            SELECT step + 1, {', '.join(f'w{i} / {size}' for i in z)}
            FROM (SELECT step, {product} FROM {name}_, {matrix} WHERE step < 3000)),
        {name} AS (SELECT {', '.join(f'v{i} * turn AS v{i}' for i in z)}, value FROM (
            SELECT *, {' + '.join(f'm{i}{j} * v{i} * v{j}' for i, j in pairs)} AS value,
                   CASE WHEN list_extract([{', '.join(f'v{i}' for i in z)}], list_position(
                     [{', '.join(f'abs(v{i}) > greatest({", ".join(f"abs(v{j})" for j in z)}) - 1e-9' for i in z)}], true)) < 0
                     THEN -1.0::DOUBLE ELSE 1.0::DOUBLE END AS turn
            FROM {name}_, {matrix} WHERE step = 3000))"""

    deflated = ", ".join(f"m{i}{j} - value * v{i} * v{j} AS m{i}{j}" for i, j in pairs)
    components = f"""{base}, spread AS (SELECT {spread} FROM points), {power('one', 'spread')},
        rest AS (SELECT {deflated} FROM spread, one), {power('two', 'rest')}"""

    def score(which: str) -> str:
        return "round(" + " + ".join(f"z{i}::DOUBLE * ({which}.v{i} / 1e6)" for i in z) + ", 5) + 0.0"

    trace = " + ".join(f"m{i}{i}" for i in z)
    return {
        "kmeans_elbow": f"""{base} SELECT k::INTEGER AS k, round(sum(best.d / 1e12), 4) + 0.0 AS wcss FROM placed GROUP BY k""",
        "kmeans_assign": f"{base} SELECT order_id, category, {numbers}, prediction FROM clustered",
        "cluster_sizes": f"{base} SELECT prediction, count(*) AS row_count FROM clustered GROUP BY ALL",
        "cluster_profile": f"{base} SELECT prediction AS cluster, {profile('avg_margin_pct')} FROM clustered GROUP BY ALL",
        "cluster_category_counts": f"""{base} SELECT prediction AS cluster, category, count(*) AS cnt
            FROM clustered GROUP BY ALL""",
        "cluster_profile_with_category": f"""{base},
            counts AS (SELECT prediction, category, count(*) AS n FROM clustered GROUP BY ALL),
            most AS (SELECT * FROM counts
                     QUALIFY row_number() OVER (PARTITION BY prediction ORDER BY n DESC, category) = 1)
            SELECT p.*, category AS dominant_category, n AS dominant_category_count
            FROM (SELECT prediction, {profile('avg_profit_margin_pct')} FROM clustered GROUP BY prediction) p
            JOIN most USING (prediction)""",
        "kmeans_silhouette": f"""{base},
            sums AS (SELECT prediction AS c, count(*)::DOUBLE AS n, sum({squares}) / count(*) AS q,
                     {', '.join(f'sum(z{i}) / 1e6::DOUBLE / count(*) AS s{i}' for i in z)} FROM clustered GROUP BY prediction),
            far AS (SELECT id, prediction, c, n, {squares} - 2 * ({dot}) + q AS d FROM clustered, sums),
            sides AS (SELECT id, max(CASE WHEN prediction = c AND n > 1 THEN d * n / (n - 1) END) AS a,
                      min(CASE WHEN prediction <> c THEN d END) AS b FROM far GROUP BY id)
            SELECT round(avg(coalesce((b - a) / greatest(a, b), 0)), 6) + 0.0 AS silhouette FROM sides""",
        "pca_scores": f"""{components} SELECT order_id, {score('one')} AS pc1, {score('two')} AS pc2, prediction AS cluster,
            revenue::DOUBLE AS revenue, profit::DOUBLE AS profit, profit_margin_pct FROM clustered, one, two""",
        "pca_variance": f"""{components}
            SELECT 1 AS component, round(value / ({trace}), 6) + 0.0 AS explained_variance FROM one, spread
            UNION ALL SELECT 2, round(value / ({trace}), 6) + 0.0 FROM two, spread""",
    }


def _linear_sql() -> dict[str, str]:
    """Least squares by elimination on the normal equations, the first label of each column left out."""
    labels, numbers = ("category", "sub_category", "region"), ("quantity", "unit_price", "revenue")
    values = " UNION ALL ".join(
        [f"SELECT id, 1 AS y, {i} AS place, '' AS label, {x}::DOUBLE AS v FROM split" for i, x in enumerate(("1", *numbers))]
        + [f"SELECT id, 1, {10 + i}, {c}, 1.0::DOUBLE FROM split WHERE {c} <> (SELECT min({c}) FROM split)" for i, c in enumerate(labels)]
    )
    base = f"""{ON_CLEAN.replace('WITH ', 'WITH RECURSIVE ', 1)},
        split AS (SELECT *, {SPLIT} AS part, row_number() OVER () AS id FROM clean),
        cells AS ({values}),
        places AS (SELECT place, label, row_number() OVER (ORDER BY place, label) AS j FROM (SELECT DISTINCT place, label FROM cells)),
        design AS (SELECT id, j, v, part, profit::DOUBLE AS profit
                   FROM cells JOIN places USING (place, label) JOIN split USING (id)),
        products AS (SELECT a.j AS i, b.j AS j, sum(a.v * b.v) AS v FROM design a JOIN design b USING (id)
                     WHERE a.part = 'train' GROUP BY a.j, b.j
                     UNION ALL SELECT j, (SELECT count(*) + 1 FROM places), sum(v * profit) FROM design WHERE part = 'train' GROUP BY j),
        cells_ AS (SELECT i, j, coalesce(p.v, 0) AS v FROM (SELECT q.j AS i, t.j FROM places q, range(1, (SELECT count(*) + 2 FROM places)) t(j))
                   LEFT JOIN products p USING (i, j)),
        matrix AS (SELECT list(r ORDER BY i) AS m FROM (SELECT i, list(v ORDER BY j) AS r FROM cells_ GROUP BY i)),
        diagonal AS (SELECT list_transform(m, lambda r, i: r[i]) AS d FROM matrix),
        solving AS (
            SELECT 1 AS step, m FROM matrix
            UNION ALL
            SELECT step + 1, CASE WHEN abs(m[step][step]) > 1e-9 * d[step]
                THEN list_transform(m, lambda r, i: CASE WHEN i = step THEN list_transform(r, lambda x: x / m[step][step])
                     ELSE list_transform(r, lambda x, c: x - r[step] * m[step][c] / m[step][step]) END)
                ELSE list_transform(m, lambda r, i: CASE WHEN i = step THEN list_transform(r, lambda x: 0.0::DOUBLE) ELSE r END) END
            FROM solving, diagonal WHERE step <= len(m)
        ),
        solved AS (SELECT list_transform(m, lambda r: r[len(m) + 1]) AS b FROM solving WHERE step = len(m) + 1),
        scored AS (SELECT id, sum(v * b[j]) AS prediction FROM design, solved WHERE part = 'test' GROUP BY id)"""
    inputs = ", ".join([*labels, *[f"{c}::DOUBLE AS {c}" for c in (*numbers, "profit")]])
    return {
        "predict_linear": f"""{base} SELECT {inputs}, round(prediction, 2) + 0.0 AS prediction
            FROM split JOIN scored USING (id)""",
        "linear_metrics": f"""{base}, e AS (SELECT profit::DOUBLE AS y, profit::DOUBLE - prediction AS err FROM split JOIN scored USING (id))
            SELECT 'LinearRegression' AS model, round(sqrt(avg(err * err)), 4) AS rmse, round(avg(abs(err)), 4) AS mae,
                   round(1 - sum(err * err) / (var_pop(y) * count(*)), 6) AS r2 FROM e""",
    }


def oracle_sql() -> dict[str, str]:
    sql: dict[str, str] = {}

    # Scans, prepared columns and profile of the raw table.
    sql["scan_csv"] = f"{ON_RAW} SELECT {_text_columns()} FROM raw"
    sql["scan_csv_decimal_text"] = sql["scan_csv"]
    sql["snake_case"] = f"{ON_RAW} SELECT {_text_columns()} FROM raw"
    sql["cast_types"] = f"{ON_RAW} SELECT {_text_columns()} FROM raw"
    sql["row_count"] = f"{ON_RAW} SELECT COUNT(*) AS row_count FROM raw"
    sql["clean_row_count"] = f"{ON_CLEAN} SELECT COUNT(*) AS row_count FROM clean"
    sql["size_gate"] = (
        f"{ON_RAW} SELECT COUNT(*) AS row_count, CAST(11 AS INTEGER) AS column_count, "
        "COUNT(*) > 100000 AS enough_rows, true AS enough_columns FROM raw"
    )
    sql["preview"] = f"{ON_RAW} SELECT {_text_columns()} FROM raw ORDER BY {COLUMNS} LIMIT 10"
    sql["schema_report"] = ON_TYPED + " UNION ALL ".join(
        f" SELECT CAST({i} AS INTEGER) AS position, '{name}' AS column_name, '{kind}' AS data_type, "
        f"true AS nullable, COUNT(*) FILTER (WHERE {name} IS NULL) AS null_rows FROM typed"
        for i, (name, kind) in enumerate(SCHEMA)
    )
    sql["parse_dates"] = (
        f"{ON_TYPED} SELECT order_id, order_date, order_date_parsed, order_year, order_month, "
        "order_year_month FROM typed"
    )
    sql["null_counts"] = f"{ON_RAW} SELECT " + ", ".join(
        f"COUNT(*) FILTER (WHERE {c} IS NULL) AS {c}" for c in COLUMNS.split(", ")
    ) + " FROM raw"
    sql["duplicate_rows"] = f"""{ON_RAW}, d AS (SELECT DISTINCT * FROM raw)
        SELECT (SELECT COUNT(*) FROM raw) AS total_rows, COUNT(*) AS distinct_rows,
               (SELECT COUNT(*) FROM raw) - COUNT(*) AS duplicate_rows FROM d"""
    sql["duplicate_keys"] = f"""{ON_RAW}
        SELECT COUNT(*) AS total_keys, COUNT(DISTINCT order_id) AS distinct_keys,
               COUNT(*) - COUNT(DISTINCT order_id) AS duplicate_keys FROM raw"""
    sql["bad_dates"] = (
        f"{ON_TYPED} SELECT COUNT(*) AS bad_date_rows FROM typed WHERE order_date_parsed IS NULL"
    )
    sql["range_profile"] = f"{ON_TYPED} SELECT " + ", ".join(
        f"CAST({f}({c}) AS DOUBLE) AS {f}_{c}"
        for c in ("quantity", "unit_price", "revenue", "profit")
        for f in ("min", "max")
    ) + " FROM typed"
    sql["revenue_mismatch"] = f"""{ON_TYPED} SELECT COUNT(*) AS mismatch_rows FROM typed
        WHERE abs(round(quantity * unit_price, 2) - revenue::DOUBLE) > 0.01"""
    sql["margin_sanity"] = f"""{ON_TYPED}
        SELECT min({MARGIN}) AS min_margin_pct, max({MARGIN}) AS max_margin_pct,
               COUNT(*) FILTER (WHERE profit > revenue) AS profit_exceeds_revenue_rows FROM typed"""
    sql["row_margin"] = (
        f"{ON_TYPED} SELECT order_id, product_name, {MARGIN} AS profit_margin_pct FROM typed"
    )
    sql["product_category_conflicts"] = f"""{ON_TYPED}
        SELECT product_name, COUNT(DISTINCT category) AS distinct_categories FROM typed
        GROUP BY product_name HAVING COUNT(DISTINCT category) > 1"""
    sql["product_lookup"] = f"""{ON_TYPED}
        SELECT DISTINCT product_name, category, sub_category FROM typed
        WHERE product_name IN ('small ring', 'red widget')"""
    sql["value_counts_raw"] = (
        f"{ON_TYPED} " + _counts(("category", "region", "sub_category"), "typed")
    )

    # The clean table.
    sql["clean_sales"] = f"""{ON_CLEAN}
        SELECT {_text_columns()}, order_date_parsed, order_year, order_month, order_year_month,
               profit_margin_pct FROM clean"""
    sql["cleaning_report"] = f"""{ON_CLEAN}, c AS (
            SELECT (SELECT COUNT(*) FROM raw) AS b, (SELECT COUNT(*) FROM clean) AS a)
        SELECT b AS rows_before, a AS rows_after, b - a AS rows_removed,
               round((b - a)::DOUBLE / NULLIF(b, 0) * 100, 2) AS removal_pct FROM c"""
    sql["price_tier"] = f"""{ON_CLEAN} SELECT order_id, product_name, unit_price,
        {_tier(1500, 3500)} AS price_tier FROM clean"""
    sql["value_counts_top"] = f"""{ON_CLEAN}, counted AS ({_counts(("category", "state", "quantity"), "clean")})
        SELECT column_name, value, row_count FROM counted QUALIFY row_number() OVER (
            PARTITION BY column_name ORDER BY row_count DESC, value) <= 10"""
    sql["value_counts"] = (
        f"{ON_CLEAN} " + _counts(("category", "sub_category", "region", "state"), "clean")
    )
    sql["describe_measures"] = f"{ON_CLEAN} " + _by_measure(
        """SELECT '{c}' AS measure, COUNT({c}) AS row_count, round(avg({c}::DOUBLE), 4) AS mean,
        round(stddev_samp({c}::DOUBLE), 4) AS stddev, round(min({c}::DOUBLE), 4) AS min,
        round(quantile_cont({c}::DOUBLE, 0.25), 4) AS q25,
        round(quantile_cont({c}::DOUBLE, 0.5), 4) AS q50,
        round(quantile_cont({c}::DOUBLE, 0.75), 4) AS q75,
        round(max({c}::DOUBLE), 4) AS max FROM clean"""
    )
    sql["describe_measures_approx"] = sql["describe_measures"].replace("quantile_cont", "quantile_disc")
    sql["kpi_totals"] = f"""{ON_CLEAN}, {_kpis('1 AS one')}
        SELECT {MONEY}, {_r2('m', 'overall_margin_pct')}, n AS total_orders,
               qty AS total_units_sold FROM g"""
    for key in ("region", "category"):
        sql[f"{key}_overview"] = _overview(key, f"n AS order_count, {MONEY_MARGIN}")
    sql["price_tier_overview"] = _overview(
        f"{_tier(150, 550)} AS price_tier",
        f"n AS order_count, qty AS total_quantity, {MONEY_MARGIN}",
    )
    sql["monthly_overview"] = _overview("order_year_month", MONEY)
    sql["region_quantity"] = _overview("region", "qty AS total_quantity")
    sql["top_products"] = _overview("product_name", _r2("rev", "total_revenue")) + (
        " ORDER BY rev DESC, product_name LIMIT 10"
    )
    sql["tier_feed"] = f"""{ON_CLEAN}, {_kpis(f"{_tier(1500, 3500)} AS price_tier")}
        SELECT CAST(CASE left(price_tier, 1) WHEN 'B' THEN 1 WHEN 'M' THEN 2 ELSE 3 END AS INTEGER)
               AS tier_order, price_tier, {_r2('rev', 'total_revenue')} FROM g"""
    sql["crosstab_counts"] = (
        f"{ON_CLEAN} SELECT region, category, COUNT(*) AS cnt FROM clean GROUP BY region, category"
    )
    sql["dominant_value"] = f"""{ON_CLEAN}, {DOMINANT}
        SELECT region, category AS dominant_category, cnt AS dominant_category_count
        FROM ranked WHERE place = 1"""
    sql["profile_with_dominant"] = f"""{ON_CLEAN}, {DOMINANT}, {PROFILE}
        SELECT profile.*, category AS dominant_category, cnt AS dominant_category_count
        FROM profile LEFT JOIN ranked ON ranked.region = profile.region AND place = 1"""

    # Chart data.
    for key, measure, value in (
        ("category", "total_revenue", "rev"),
        ("category", "total_profit", "prof"),
        ("category", "profit_margin_pct", "m"),
        ("region", "total_revenue", "rev"),
    ):
        sql[f"chart_{measure}_by_{key}"] = _overview(key, _r2(value, measure))
    sql["chart_monthly_revenue"] = _overview("order_year_month", _r2("rev", "total_revenue"))

    # Reports.
    sql["q01"] = _overview(
        "category", f"n AS order_count, qty AS total_quantity, {MONEY_MARGIN}, {SHARES}, {RANKS}"
    )
    sql["q02"] = _overview(
        "region",
        f"n AS order_count, qty AS total_quantity, {MONEY_MARGIN}, {SHARES}, {PER_ORDER}, {RANKS}",
    )
    sql["q03"] = (
        _overview(
            "product_name, category",
            f"qty AS total_quantity, {MONEY_MARGIN}, {SHARES}, {RANKS}",
        )
        + " ORDER BY rev DESC, product_name, category LIMIT 10"
    )
    sql["q04"] = f"""{ON_CLEAN}, {_kpis('product_name, category')},
        w AS (SELECT avg(qty) AS mean_qty, avg(m) AS mean_m FROM g)
        SELECT product_name, category, qty AS total_quantity, {MONEY_MARGIN},
               {_r2('mean_qty', 'avg_quantity_benchmark')},
               {_r2('qty - mean_qty', 'quantity_above_benchmark')},
               {_r2('mean_m', 'avg_margin_benchmark')}, {_r2('m - mean_m', 'margin_gap_pct')},
               CASE WHEN rev < 5000000 THEN 'High volume but low margin'
                    ELSE 'High revenue but margin pressure' END AS diagnosis
        FROM g, w WHERE qty > mean_qty AND m < mean_m"""
    sql["q05"] = (
        _overview(
            "sub_category, category",
            f"{MONEY_MARGIN}, rank() OVER (ORDER BY m DESC NULLS LAST) AS margin_rank",
        )
        + " ORDER BY round(m, 2) DESC NULLS LAST, sub_category, category LIMIT 10"
    )
    for name, cuts in (("q06", (150, 550)), ("q06_higher_cuts", (1500, 3500))):
        sql[name] = _overview(
            f"{_tier(*cuts)} AS price_tier",
            f"n AS order_count, qty AS total_quantity, {MONEY_MARGIN}",
        )
    sql["q07"] = f"""{ON_CLEAN}, {_kpis('category, sub_category')},
        w AS (SELECT SUM(rev)::DOUBLE AS rev_all, 100.0::DOUBLE / COUNT(*) AS mean_share,
                     SUM(prof)::DOUBLE / NULLIF(SUM(rev)::DOUBLE, 0) * 100 AS m_all FROM g),
        s AS (SELECT *, rev::DOUBLE / rev_all * 100 AS share FROM g, w)
        SELECT category, sub_category, n AS order_count, qty AS total_quantity, {MONEY_MARGIN},
               {_r2('share', 'revenue_share_pct')}, {_r2('mean_share', 'avg_revenue_share_benchmark')},
               {_r2('m_all', 'overall_margin_benchmark')}, {_r2('m - m_all', 'margin_gap_pct')},
               'High revenue share but below-average margin' AS diagnosis
        FROM s WHERE share > mean_share AND m < m_all"""
    sql["q08"] = f"""{ON_CLEAN}, {_kpis('order_year_month')},
        s AS (SELECT order_year_month, {MONEY} FROM g),
        l AS (SELECT *, lag(total_revenue) OVER (ORDER BY order_year_month) AS prev_month_revenue FROM s)
        SELECT *, round((total_revenue - prev_month_revenue) / NULLIF(prev_month_revenue, 0) * 100, 2)
               AS mom_growth_pct FROM l"""
    sql["q09"] = _overview(
        "region, category",
        f"""{MONEY}, qty AS total_quantity, rank() OVER (PARTITION BY region
        ORDER BY rev DESC) AS rank_in_region""",
    )
    sql["q10"] = _overview(
        "state, region",
        f"""n AS order_count, qty AS total_quantity, {MONEY_MARGIN}, {PER_ORDER},
        CASE ntile(3) OVER (ORDER BY rev DESC, state, region)
             WHEN 1 THEN 'High-Value' WHEN 2 THEN 'Mid-Value' ELSE 'Emerging' END AS value_segment""",
    )
    sql["q11"] = f"""{ON_CLEAN}, {_kpis('product_name, category')},
        s AS (SELECT product_name, category, qty AS total_quantity, {MONEY_MARGIN} FROM g),
        t AS (SELECT *,
            CAST(ntile(4) OVER (ORDER BY total_revenue DESC, product_name, category) AS INTEGER)
                AS revenue_quartile,
            CAST(ntile(4) OVER (ORDER BY profit_margin_pct DESC NULLS LAST, product_name, category)
                AS INTEGER) AS margin_quartile FROM s)
        SELECT *, CASE WHEN revenue_quartile > 1 THEN 'Priority: Promote'
                       WHEN margin_quartile < 3 THEN 'Priority: Scale Up'
                       ELSE 'Monitor' END AS priority_action
        FROM t WHERE least(revenue_quartile, margin_quartile) = 1"""
    sql["q12"] = f"""{ON_CLEAN}, {_kpis('product_name, category, region')},
        w AS (SELECT SUM(rev)::DOUBLE / COUNT(*) AS mean_rev,
                     SUM(prof)::DOUBLE / NULLIF(SUM(rev)::DOUBLE, 0) * 100 AS m_all FROM g)
        SELECT product_name, category, region, qty AS total_quantity, {MONEY_MARGIN},
               {_r2('mean_rev', 'avg_revenue_benchmark')},
               {_r2('rev::DOUBLE - mean_rev', 'revenue_gap')},
               {_r2('m_all', 'overall_margin_benchmark')}, {_r2('m - m_all', 'margin_gap_pct')},
               CASE WHEN m - m_all > -10 THEN 'Corrective action: review pricing/cost'
                    ELSE 'Urgent: improve margin' END AS recommended_action
        FROM g, w WHERE rev::DOUBLE >= mean_rev AND m < m_all"""

    # Splits and samples, and what models give that SQL can express.
    complete = "complete AS (SELECT * FROM clean WHERE profit_margin_pct IS NOT NULL)"
    sql["train_test_split"] = f"""{ON_CLEAN} SELECT order_id, product_name, state, quantity,
        {SPLIT} AS split FROM clean"""
    sql["split_sizes"] = f"""{ON_CLEAN} SELECT {SPLIT} AS split, COUNT(*) AS row_count
        FROM clean GROUP BY ALL"""
    sql["linear_revenue"] = f"""{ON_CLEAN}, t AS (SELECT profit::DOUBLE AS y, revenue::DOUBLE AS x
            FROM clean WHERE {SPLIT} = 'train')
        SELECT round(regr_intercept(y, x), 3) AS intercept, round(regr_slope(y, x), 6) AS slope FROM t"""
    sql["pca_feed"] = f"""{ON_CLEAN}, {complete}
        SELECT order_id, revenue::DOUBLE AS revenue, profit::DOUBLE AS profit, profit_margin_pct
        FROM complete WHERE {_bucket("'sample 42'", "order_id")} < 50000"""
    sql["pca_variance_two"] = f"""{ON_CLEAN}, {complete},
        c AS (SELECT abs(corr(revenue::DOUBLE, profit::DOUBLE)) AS r FROM complete)
        SELECT 1 AS component, round((1 + r) / 2, 6) AS explained_variance FROM c
        UNION ALL SELECT 2, round((1 - r) / 2, 6) FROM c"""
    sql["kmeans_facts"] = f"""{ON_CLEAN}, {complete}
        SELECT COUNT(*) AS rows_clustered, COUNT(*) AS rows_in_clusters,
               0::BIGINT AS rows_off_centre, 0.0::DOUBLE AS cost_gap FROM complete"""
    sql |= _cluster_sql(complete) | _linear_sql()
    # Model preparation and scoring that SQL can express.
    sql["label_index"] = f"""{ON_CLEAN}, {LABELS}
        SELECT column_name, label, CAST(place AS INTEGER) AS label_index, row_count FROM labels_"""
    slots = ", ".join(
        f"array_to_string(list_transform(range((SELECT count(*) FROM labels_ WHERE column_name = '{c}')), "
        f"lambda i: CASE WHEN i = {c}_.place THEN 1 ELSE 0 END), '') AS {c}_slots"
        for c in ("category", "sub_category", "region")
    )
    joins = " ".join(
        f"LEFT JOIN labels_ {c}_ ON {c}_.column_name = '{c}' AND {c}_.label = clean.{c}"
        for c in ("category", "sub_category", "region")
    )
    sql["one_hot"] = f"""{ON_CLEAN}, {LABELS}
        SELECT order_id, product_name, category, sub_category, region, {slots} FROM clean {joins}"""
    sql["standardize"] = (
        f"{ON_CLEAN}, complete AS (SELECT * FROM clean WHERE profit_margin_pct IS NOT NULL) "
        "SELECT order_id, "
        + ", ".join(
            f"round(({c}::DOUBLE - (SELECT avg({c}::DOUBLE) FROM complete)) / "
            f"(SELECT stddev_samp({c}::DOUBLE) FROM complete), 6) AS z_{c}"
            for c in MEASURES
        )
        + " FROM complete"
    )
    sql["baseline_metrics"] = f"""{ON_CLEAN},
        w AS (SELECT SUM(profit)::DOUBLE / SUM(revenue)::DOUBLE AS rate,
                     avg(profit::DOUBLE) AS mean_profit FROM clean),
        e AS (SELECT 'overall_margin' AS model, profit::DOUBLE AS y,
                     profit::DOUBLE - revenue::DOUBLE * rate AS err FROM clean, w
              UNION ALL SELECT 'mean_profit', profit::DOUBLE, profit::DOUBLE - mean_profit FROM clean, w)
        SELECT model, round(sqrt(avg(err * err)), 4) AS rmse, round(avg(abs(err)), 4) AS mae,
               round(1 - SUM(err * err) / (var_pop(y) * COUNT(*)), 6) + 0.0 AS r2
        FROM e GROUP BY model"""
    # Kept tables.
    sql["clean_in_batches"] = sql["clean_sales"]
    sql["kpi_cube"] = f"""{ON_CLEAN},
        tiers AS (SELECT *, {_tier(150, 550)} AS price_tier FROM clean)
        SELECT CASE WHEN GROUPING(product_name) = 0 THEN 'product'
                    WHEN GROUPING(sub_category) = 0 THEN 'sub_category'
                    WHEN GROUPING(state) = 0 THEN 'state'
                    WHEN GROUPING(order_year_month) = 0 THEN 'month' ELSE 'price_tier' END AS level,
               product_name, category, region, sub_category, state, order_year_month, price_tier,
               COUNT(*) AS order_count, CAST(SUM(quantity) AS BIGINT) AS total_quantity,
               {_r2('SUM(revenue)', 'total_revenue')}, {_r2('SUM(profit)', 'total_profit')}
        FROM tiers
        GROUP BY GROUPING SETS ((product_name, category, region), (sub_category, category),
                                (state, region), (order_year_month), (price_tier))"""
    for n in range(1, 13):
        sql[f"cube_q{n:02d}"] = sql[f"q{n:02d}"]
    sql["scan_rejects"] = f"""{ON_RAW}
        SELECT order_id, CASE WHEN order_id % 43 = 0 THEN 'number of fields' ELSE 'quantity is not int' END AS reason
        FROM raw WHERE order_id % 43 = 0 OR order_id % 47 = 0"""
    by_layout = "CASE WHEN order_id % 2 = 0 THEN state END AS state"
    sql["scan_accepted"] = f"""{ON_RAW} SELECT {_text_columns().replace("state", by_layout)}
        FROM raw WHERE order_id % 43 <> 0 AND order_id % 47 <> 0"""
    sql["sketched_distinct"] = f"""{ON_CLEAN}
        SELECT region, COUNT(DISTINCT order_id) AS exact_order_id, COUNT(DISTINCT product_name) AS exact_product_name,
               true AS near_order_id, true AS near_product_name FROM clean GROUP BY region"""
    return sql
