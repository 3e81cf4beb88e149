"""The named queries as plain SQL over the given tables, for comparison on another engine."""

from __future__ import annotations

from itertools import combinations

SEED = 42
CLASSES = ("F", "O", "P")
BANDS = ("u", "g", "r", "i", "z")
FEATURES = ("r", "redshift", "u_g", "g_r", "r_i", "i_z")
PAIRS = (("u", "g"), ("g", "r"), ("r", "i"), ("i", "z"))


def _md5(seed: object, key: str) -> str:
    return f"md5(concat_ws(',', '{seed}', {key}))"


def _number(seed: object, *keys: str) -> str:
    return f"(('0x' || substr(md5(concat_ws(',', '{seed}', {', '.join(keys)})), 1, 8))::BIGINT)"


def _exact(column: str) -> str:
    return f"coalesce('v' || {column}, 'n')"


def _exact_float(column: str) -> str:
    scaled = f"({column}::DOUBLE * 1e6::DOUBLE)"
    rest = f"floor(({scaled} - floor({scaled})) * 1e9::DOUBLE)::BIGINT"
    return f"coalesce('v' || floor({scaled})::BIGINT || ':' || {rest}, 'n')"


OBS = """obs AS (
  SELECT o.o_orderkey AS obj_id, o.o_custkey AS field_id, c.c_nationkey AS run_id,
         date_diff('day', DATE '1858-11-17', CAST(o.o_orderdate AS DATE))::BIGINT AS mjd,
         o.o_orderstatus AS class,
         coalesce(l.u, -9999.0::DOUBLE) AS u, coalesce(l.g, -9999.0::DOUBLE) AS g, o.o_totalprice AS r,
         coalesce(l.i, -9999.0::DOUBLE) AS i, coalesce(l.z, -9999.0::DOUBLE) AS z, c.c_acctbal AS redshift
  FROM orders o
  LEFT JOIN customer c ON c.c_custkey = o.o_custkey
  LEFT JOIN (SELECT l_orderkey, max(l_extendedprice) AS u, max(l_quantity) AS g, max(l_discount) AS i,
                    max(l_tax) AS z FROM lineitem GROUP BY l_orderkey) l ON l.l_orderkey = o.o_orderkey
)"""
NULLED = (
    "nulled AS (SELECT obj_id, field_id, run_id, mjd, class, redshift, "
    + ", ".join(f"nullif({b}, -9999) AS {b}" for b in BANDS)
    + " FROM obs)"
)
CLEAN = (
    "cleaned AS (SELECT obj_id, field_id, class, r, redshift, "
    + ", ".join(f"{a} - {b} AS {a}_{b}" for a, b in PAIRS)
    + " FROM nulled)"
)
CUT = """cut AS (
  SELECT *, row_number() OVER (ORDER BY mjd, obj_id) AS pos, count(*) OVER () AS n FROM obs
), sided AS (
  SELECT *, CASE WHEN pos > n - CAST(floor(0.2 * n) AS BIGINT) THEN 'prod' ELSE 'train' END AS side FROM cut
)"""
GROUP_SIDES = f"""sides AS (
  SELECT field_id, CASE WHEN row_number() OVER (ORDER BY {_md5(SEED, 'field_id')})
                   <= floor(0.85 * count(*) OVER ()) THEN 'train' ELSE 'test' END AS side
  FROM (SELECT DISTINCT field_id FROM obs)
)"""
FOLDS = f"""sizes AS (
  SELECT field_id, class, count(*) AS n FROM obs GROUP BY ALL
), groups AS (
  SELECT field_id, sum(n)::BIGINT AS group_rows, first(class ORDER BY n DESC, class) AS majority
  FROM sizes GROUP BY field_id
), placed AS (
  SELECT *, row_number() OVER (ORDER BY majority, group_rows DESC, {_md5(SEED, 'field_id')}) - 1 AS place FROM groups
), folds AS (
  SELECT field_id, group_rows,
         (CASE WHEN (place // 3) % 2 = 0 THEN place % 3 ELSE 2 - place % 3 END)::INTEGER AS fold FROM placed
)"""
_W = {
    c: f"(1 + {_number('w' + c, 'obj_id')} % 1000 + CASE WHEN class = '{c}' THEN 300 ELSE 0 END)::DOUBLE"
    for c in CLASSES
}
PRED = f"""weights AS (
  SELECT *, {_W['F']} AS w0, {_W['O']} AS w1, {_W['P']} AS w2 FROM obs
), pred AS (
  SELECT obj_id, class, mjd, w0 / (w0 + w1 + w2) AS p0, w1 / (w0 + w1 + w2) AS p1, w2 / (w0 + w1 + w2) AS p2,
         CASE WHEN w0 >= w1 AND w0 >= w2 THEN 0 WHEN w1 >= w2 THEN 1 ELSE 2 END AS code
  FROM weights
), scored AS (
  SELECT *, ['F', 'O', 'P'][code + 1] AS prediction,
         CASE class WHEN 'F' THEN 0 WHEN 'O' THEN 1 ELSE 2 END AS truth FROM pred
)"""
IMPUTED = (
    "medians AS (SELECT "
    + ", ".join(f"median({c}) AS {c}" for c in FEATURES)
    + " FROM cleaned), imputed AS (SELECT obj_id, class, "
    + ", ".join(f"coalesce(c.{c}, m.{c}) AS {c}" for c in FEATURES)
    + " FROM cleaned c, medians m)"
)
PER_CLASS = """cm AS (
  SELECT class AS t, prediction AS p, count(*) AS n FROM scored GROUP BY ALL
), per_class AS (
  SELECT l.label, coalesce(sum(n) FILTER (t = l.label), 0)::DOUBLE AS support,
         coalesce(sum(n) FILTER (p = l.label), 0)::DOUBLE AS called,
         coalesce(sum(n) FILTER (t = l.label AND p = l.label), 0)::DOUBLE AS hits
  FROM (SELECT unnest(['F', 'O', 'P']) AS label) l, cm GROUP BY l.label
), prf AS (
  SELECT label, support, hits, CASE WHEN called > 0 THEN hits / called ELSE 0 END AS "precision",
         CASE WHEN support > 0 THEN hits / support ELSE 0 END AS recall,
         CASE WHEN called + support > 0 THEN 2 * hits / (called + support) ELSE 0 END AS f1
  FROM per_class
)"""


def _with(*parts: str) -> str:
    return "WITH " + ",\n".join(parts) + "\n"


def _round(columns, digits: int = 6) -> str:
    return ", ".join(f"round({c}, {digits}) AS {c}" for c in columns)


def _describe(columns, source: str) -> str:
    return " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, count({c}) AS n, round(avg({c}), 6) AS mean, round(stddev_samp({c}), 6) AS std, "
        f"round(min({c})::DOUBLE, 6) AS \"min\", round(quantile_cont({c}::DOUBLE, 0.25), 6) AS q25, "
        f"round(quantile_cont({c}::DOUBLE, 0.5), 6) AS q50, round(quantile_cont({c}::DOUBLE, 0.75), 6) AS q75, "
        f"round(max({c})::DOUBLE, 6) AS \"max\" FROM {source}"
        for c in columns
    )


def _kde(column: str, common: bool) -> str:
    scale = "k.n / (SELECT sum(n) FROM k)" if common else "1.0"
    return (
        _with(
            OBS,
            f"k AS (SELECT class, count({column}) AS n, pow(count({column}), -0.2) * stddev_samp({column}) AS h, "
            f"min({column})::DOUBLE AS low, max({column})::DOUBLE AS high FROM obs GROUP BY class)",
            "grid AS (SELECT k.*, g.range::INTEGER AS grid_point, low - 3 * h + g.range * (high - low + 6 * h) / 199 AS x "
            "FROM k, range(200) g)",
            f"vals AS (SELECT class, {column}::DOUBLE AS v, count(*) AS w FROM obs GROUP BY ALL)",
        )
        + f"""SELECT k.class, k.grid_point, round(k.x, 6) AS x,
  round(sum(w * exp(-0.5 * pow((k.x - v.v) / k.h, 2))) * ({scale.replace('k.n', 'any_value(k.n)')})
        / (any_value(k.n) * any_value(k.h) * sqrt(2 * pi())), 9) AS density
FROM grid k JOIN vals v ON v.class = k.class GROUP BY k.class, k.grid_point, k.x"""
    )


def _correlations(columns, source: str) -> str:
    return " UNION ALL ".join(
        f"SELECT '{a}' AS column_a, '{b}' AS column_b, round(corr({a}, {b}), 6) AS correlation FROM {source}"
        for a, b in combinations(columns, 2)
    )


def _spearman() -> str:
    parts = []
    for a, b in combinations(FEATURES, 2):
        rank = "rank() OVER (ORDER BY {c}) + (count(*) OVER (PARTITION BY {c}) - 1) / 2.0::DOUBLE"
        parts.append(
            f"SELECT '{a}' AS column_a, '{b}' AS column_b, round(corr(x, y), 6) AS correlation FROM "
            f"(SELECT {rank.format(c=a)} AS x, {rank.format(c=b)} AS y FROM cleaned "
            f"WHERE {a} IS NOT NULL AND {b} IS NOT NULL)"
        )
    return _with(OBS, NULLED, CLEAN) + " UNION ALL ".join(parts)


def _skewness(c: str) -> str:
    return (
        f"SELECT '{c}' AS column_name, "
        f"round(avg(pow({c} - m, 3)) / pow(sqrt(avg(pow({c} - m, 2))), 3), 6) AS skewness, "
        f"round(avg(pow({c} - m, 4)) / pow(avg(pow({c} - m, 2)), 2) - 3, 6) AS kurtosis "
        f"FROM nulled, (SELECT avg({c}) AS m FROM nulled)"
    )


def _chi_square(source: str, a: str, b: str) -> str:
    return f"""cells AS (SELECT {a} AS a, {b} AS b, count(*) AS o FROM {source} GROUP BY ALL),
ra AS (SELECT a, sum(o)::DOUBLE AS r FROM cells GROUP BY a), cb AS (SELECT b, sum(o)::DOUBLE AS c FROM cells GROUP BY b),
full_table AS (
  SELECT coalesce(o, 0) AS o, r * c / (SELECT sum(o) FROM cells) AS e
  FROM ra CROSS JOIN cb LEFT JOIN cells USING (a, b)
), shape AS (SELECT ((SELECT count(*) FROM ra) - 1) * ((SELECT count(*) FROM cb) - 1) AS dof)
SELECT round(sum(CASE WHEN dof = 1 THEN pow(abs(o - e) - least(0.5, abs(o - e)), 2) / e ELSE pow(o - e, 2) / e END), 6)
       AS statistic, any_value(dof) AS dof FROM full_table, shape"""


_RULE = "CASE WHEN {r} > 150000 THEN 'F' WHEN {redshift} < 3000 THEN 'O' ELSE 'P' END"


RULE_FOLDS = f"""ruled AS (SELECT fold, class, {_RULE.format(r='r', redshift='redshift')} AS prediction FROM obs JOIN folds USING (field_id)
), per_class AS (
  SELECT fold, label, count(*) FILTER (class = label)::DOUBLE AS support, count(*) FILTER (prediction = label)::DOUBLE AS called,
         count(*) FILTER (class = label AND prediction = label)::DOUBLE AS hits
  FROM ruled, (SELECT unnest(['F', 'O', 'P']) AS label) GROUP BY fold, label
), scores AS (
  SELECT *, CASE WHEN called > 0 THEN hits / called ELSE 0 END AS p, CASE WHEN support > 0 THEN hits / support ELSE 0 END AS r,
         CASE WHEN called + support > 0 THEN 2 * hits / (called + support) ELSE 0 END AS f FROM per_class
), fold_metrics AS (
  SELECT fold, NULL::DOUBLE AS log_loss, round(sum(hits) / sum(support), 4) AS accuracy, round(sum(f * support) / sum(support), 4) AS f1,
         round(sum(p * support) / sum(support), 4) AS "precision", round(sum(r * support) / sum(support), 4) AS recall, NULL::DOUBLE AS roc_auc
  FROM scores GROUP BY fold
)"""


def _ks_drift(alpha: float = 0.05) -> str:
    far = "2 * list_sum(list_transform(range(1, 101), lambda k: pow(-1, k - 1) * exp(-2.0 * k * k * x * x)))"
    near = "sqrt(2 * pi()) / x * list_sum(list_transform(range(1, 21), lambda k: exp(-pow(2 * k - 1, 2) * pi() * pi() / (8 * x * x))))"
    parts = " UNION ALL ".join(
        f"""SELECT '{c}' AS feature, any_value(n) AS n_reference, any_value(m) AS n_current, max(abs(f / n - g / m)) AS d FROM (
          SELECT sum((side = 'train')::INT) OVER w AS f, sum((side = 'prod')::INT) OVER w AS g,
                 count(*) FILTER (side = 'train') OVER () AS n, count(*) FILTER (side = 'prod') OVER () AS m
          FROM cleaned JOIN sided USING (obj_id) WHERE cleaned.{c} IS NOT NULL WINDOW w AS (ORDER BY cleaned.{c}))"""
        for c in FEATURES
    )
    return (
        _with(OBS, NULLED, CLEAN, CUT, f"gaps AS ({parts})")
        + f"""SELECT feature, n_reference, n_current, round(d, 6) AS statistic, round(p, 6) AS p_value, p < {alpha} AS drifted FROM (
  SELECT *, CASE WHEN x <= 0 THEN 1.0 WHEN x < 0.5 THEN 1 - {near} ELSE greatest(0.0, {far}) END::DOUBLE AS p
  FROM (SELECT *, d * sqrt(n_reference::DOUBLE * n_current / (n_reference + n_current)) AS x FROM gaps))"""
    )


def _smote() -> str:
    scaled = ", ".join(f"(c.{c} - m.{c}_low) / m.{c}_range AS {c}" for c in FEATURES)
    ranges = ", ".join(f"min({c}) AS {c}_low, max({c}) - min({c}) AS {c}_range" for c in FEATURES)
    distance = "sqrt(" + " + ".join(f"(b.{c} - s.{c}) * (b.{c} - s.{c})" for c in FEATURES) + ")"
    order = ", ".join(f"s.{c}" for c in FEATURES)
    points = ", ".join(f"round(d.{c} + u * (n.n_{c} - d.{c}), 6) AS {c}" for c in FEATURES)
    taken = ", ".join(f"s.{c} AS n_{c}" for c in FEATURES)
    return (
        _with(
            OBS,
            NULLED,
            CLEAN,
            IMPUTED,
            f"ranges AS (SELECT {ranges} FROM imputed)",
            f"scaled AS (SELECT obj_id, class, {scaled} FROM imputed c, ranges m)",
            "sizes AS (SELECT class, count(*) AS n FROM scaled GROUP BY class)",
            "wanted AS (SELECT class, n, (SELECT max(n) FROM sizes) - n AS missing FROM sizes)",
            f"""bases AS (SELECT s.*, w.missing // w.n
  + CASE WHEN row_number() OVER (PARTITION BY s.class ORDER BY {_md5(SEED, 's.obj_id')}) <= w.missing % w.n
         THEN 1 ELSE 0 END AS copies FROM scaled s JOIN wanted w USING (class) WHERE w.missing > 0)""",
            f"drawn AS (SELECT b.*, t.copy, {_number(f'{SEED}n', 'b.obj_id', 't.copy')} % 5 + 1 AS pick, "
            f"{_number(f'{SEED}u', 'b.obj_id', 't.copy')} / 4294967296.0::DOUBLE AS u "
            "FROM bases b, unnest(range(b.copies)) t(copy))",
            f"""near AS (SELECT b.obj_id, {taken},
  row_number() OVER (PARTITION BY b.obj_id ORDER BY {distance}, {order}, s.obj_id) AS place
  FROM (SELECT * FROM bases WHERE copies > 0) b JOIN scaled s ON s.class = b.class AND s.obj_id <> b.obj_id)""",
        )
        + f"SELECT d.class, {points} FROM drawn d JOIN near n ON n.obj_id = d.obj_id AND n.place = d.pick"
    )


def _pair_auc(a: int, b: int) -> str:
    def one(up: int, down: int) -> str:
        return (
            f"(SELECT (sum(rk) FILTER (truth = {up}) - count(*) FILTER (truth = {up}) "
            f"* (count(*) FILTER (truth = {up}) + 1) / 2.0::DOUBLE) / (count(*) FILTER (truth = {up})::DOUBLE "
            f"* count(*) FILTER (truth = {down})) FROM (SELECT truth, rank() OVER (ORDER BY p{up}) "
            f"+ (count(*) OVER (PARTITION BY p{up}) - 1) / 2.0::DOUBLE AS rk FROM scored "
            f"WHERE truth IN ({up}, {down})))"
        )

    return f"SELECT ({one(a, b)} + {one(b, a)}) / 2 AS auc, (SELECT count(*) FROM scored WHERE truth IN ({a}, {b})) AS w"


_FINGERPRINT = (
    "SELECT count(*) AS dataset_row_count, sum(('0x' || substr(md5(concat_ws(',', "
    + ", ".join([*map(_exact, ("obj_id", "field_id", "run_id", "mjd", "class")), *map(_exact_float, (*BANDS, "redshift"))])
    + ")), 1, 8))::BIGINT)::DECIMAL(38, 0) AS dataset_checksum FROM "
)
_OBS, _NULLED, _CLEAN = _with(OBS), _with(OBS, NULLED), _with(OBS, NULLED, CLEAN)
_IMPUTED, _PRED = _with(OBS, NULLED, CLEAN, IMPUTED), _with(OBS, PRED)
_ALL = "obj_id, field_id, run_id, mjd, class, u, g, r, i, z, redshift"


def _scaled(centre: str, scale: str) -> str:
    stats = ", ".join(f"{centre.format(c=c)} AS {c}_m, {scale.format(c=c)} AS {c}_s" for c in FEATURES)
    columns = ", ".join(
        f"round((c.{c} - m.{c}_m) / CASE WHEN m.{c}_s = 0 THEN 1 ELSE m.{c}_s END, 6) AS {c}" for c in FEATURES
    )
    return _IMPUTED + f", stats AS (SELECT {stats} FROM imputed) SELECT obj_id, {columns} FROM imputed c, stats m"


STATEMENTS: dict[str, str] = {
    "scan_csv": _OBS + f"SELECT {_ALL} FROM obs",
    "row_count_contract": "SELECT 15000::BIGINT AS expected, count(*) AS actual, count(*) = 15000 AS ok FROM orders",
    "min_rows_check": "SELECT 1000::BIGINT AS min_rows, least(count(*), 1000)::BIGINT AS found, "
    "count(*) >= 1000 AS ok FROM orders",
    "dataset_fingerprint": _OBS + _FINGERPRINT + "obs",
    "batch_predict_intact": _with(OBS, CUT) + _FINGERPRINT + "sided WHERE side = 'prod'",
    "stream_predict_intact": _with(OBS, CUT) + _FINGERPRINT + "sided WHERE side = 'prod' AND u <> -9999",
    "pca_moments": _NULLED
    + "SELECT 1.0::DOUBLE AS total, round(("
    + " + ".join(["5", *(f"2 * corr({a}, {b}) ^ 2" for a, b in combinations(BANDS, 2))])
    + ") / 25, 6) AS squares FROM nulled WHERE "
    + " AND ".join(f"{b} IS NOT NULL" for b in BANDS),
    "sentinel_to_null": _NULLED + "SELECT u, g, r, i, z, redshift, obj_id, class FROM nulled",
    "color_indices": _OBS + "SELECT obj_id, " + ", ".join(f"round({a} - {b}, 6) AS {a}_{b}" for a, b in PAIRS) + " FROM obs",
    "clean_features": _CLEAN + f"SELECT obj_id, field_id, class, {_round(FEATURES)} FROM cleaned",
    "feature_target": _CLEAN
    + f"SELECT obj_id, class AS label, field_id AS group_id, {_round(FEATURES)} FROM cleaned",
    "filter_sentinel_rows": _OBS + f"SELECT {_ALL} FROM obs WHERE u = -9999",
    "drop_null_rows": _NULLED
    + "SELECT u, g, r, i, z, redshift, obj_id FROM nulled WHERE u IS NOT NULL AND g IS NOT NULL AND r IS NOT NULL "
    "AND i IS NOT NULL AND z IS NOT NULL",
    "replace_value": _OBS
    + "SELECT CASE WHEN obj_id = 22 THEN 1 ELSE obj_id END AS obj_id, "
    "(CASE WHEN run_id = 22 THEN 1 ELSE run_id END)::INTEGER AS run_id, "
    "CASE WHEN g = 22 THEN 1::DOUBLE ELSE g END AS g, class FROM obs",
    "binary_flag": _OBS + "SELECT obj_id, class, (class = 'O')::INTEGER AS is_open FROM obs",
    "inference_input": _OBS + "SELECT obj_id, run_id, mjd, u, g, r, i, z, redshift FROM obs",
    "preflight": _OBS
    + "SELECT count(*) AS n_rows, count(DISTINCT class) AS n_classes, count(DISTINCT field_id) AS n_groups, "
    "count(*) > 0 AND count(DISTINCT class) >= 2 AND count(DISTINCT field_id) >= 3 AS ok FROM obs",
    "unseen_labels": _with(OBS, CUT)
    + "SELECT DISTINCT field_id FROM sided WHERE side = 'prod' AND field_id NOT IN "
    "(SELECT field_id FROM sided WHERE side = 'train')",
    "decode_labels": _PRED + "SELECT obj_id, code::INTEGER AS code, prediction FROM scored",
    "group_side_join": _with(OBS, FOLDS) + "SELECT obj_id, field_id, class, fold FROM obs JOIN folds USING (field_id)",
    "horizontal_concat": _OBS + "SELECT obj_id, r, redshift, class FROM obs",
    "nunique": _OBS
    + " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, count(DISTINCT {c}) AS n_distinct FROM obs"
        for c in ("obj_id", "field_id", "run_id", "class", "mjd")
    ),
    "value_counts": _OBS
    + "SELECT class, count(*) AS n, round(count(*)::DOUBLE / (SELECT count(*) FROM obs), 6) AS share FROM obs GROUP BY class",
    "value_counts_summary": _OBS
    + ", counts AS (SELECT field_id, count(*) AS n FROM obs GROUP BY field_id) "
    + _describe(["n"], "counts"),
    "duplicate_ids": "SELECT count(*) AS n_duplicate_keys FROM "
    "(SELECT l_orderkey FROM lineitem GROUP BY l_orderkey HAVING count(*) > 1)",
    "label_consistency": "SELECT n_labels, count(*) AS n_keys FROM (SELECT count(DISTINCT l_returnflag) AS n_labels "
    "FROM lineitem GROUP BY l_orderkey HAVING count(*) > 1) GROUP BY n_labels",
    "describe": _NULLED + _describe([*BANDS, "redshift", "mjd"], "nulled"),
    "sentinel_counts": _OBS
    + " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, count(*) FILTER ({c} = -9999) AS n_sentinel, "
        f"count(*) FILTER ({c} IS NULL) AS n_null FROM obs"
        for c in BANDS
    ),
    "moments": _NULLED + " UNION ALL ".join(_skewness(c) for c in (*BANDS, "redshift")),
    "histogram": _OBS
    + """, lim AS (SELECT min(r) AS low, (max(r) - min(r)) / 50 AS w FROM obs),
counted AS (SELECT least(floor((r - low) / w), 49)::BIGINT AS bin, count(*) AS n FROM obs, lim GROUP BY 1)
SELECT b.range AS bin, round(low + b.range * w, 6) AS bin_low, round(low + (b.range + 1) * w, 6) AS bin_high,
       coalesce(n, 0) AS n FROM range(50) b CROSS JOIN lim LEFT JOIN counted ON counted.bin = b.range""",
    "kde": _kde("redshift", False),
    "kde_common_norm": _kde("mjd", True),
    "crosstab": _OBS
    + "SELECT run_id, "
    + ", ".join(f"count(*) FILTER (class = '{c}') AS class_{c}" for c in CLASSES)
    + " FROM obs GROUP BY run_id",
    "chi_square": _OBS + ", " + _chi_square("obs", "field_id", "class"),
    "chi_square_2x2": "WITH " + _chi_square("labels", "quality", "toxic"),
    "pearson": _NULLED + _correlations([*BANDS, "redshift"], "nulled"),
    "spearman": _spearman(),
    "split_metadata": _with(OBS, CUT)
    + "SELECT 0.2::DOUBLE AS split_prod_ratio, count(*) FILTER (side = 'train') AS n_train, "
    "count(*) FILTER (side = 'prod') AS n_prod, min(mjd) FILTER (side = 'train') AS train_mjd_min, "
    "max(mjd) FILTER (side = 'train') AS train_mjd_max, min(mjd) FILTER (side = 'prod') AS prod_mjd_min, "
    "max(mjd) FILTER (side = 'prod') AS prod_mjd_max, 'time_based_mjd' AS split_method FROM sided",
    "class_weights": "SELECT quality, count(*) AS n, round((SELECT count(*) FROM labels)::DOUBLE / "
    "((SELECT count(DISTINCT quality) FROM labels) * count(*)), 6) AS weight FROM labels GROUP BY quality",
    "table_info": _NULLED
    + " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, '{t}' AS data_type, count({c}) AS n_non_null, count(*) AS n_rows, "
        "8::BIGINT AS n_columns FROM nulled"
        for c, t in [(b, "double") for b in BANDS] + [("redshift", "double"), ("obj_id", "bigint"), ("class", "string")]
    ),
    "ks_drift": _ks_drift(),
    "share_drift": _with(OBS, CUT)
    + """, ref AS (SELECT class, count(*)::DOUBLE / sum(count(*)) OVER () AS share FROM sided WHERE side = 'train' GROUP BY class
), seen AS (
  SELECT (row_number() OVER (ORDER BY mjd, obj_id) - 1) // 2000 + 1 AS batch, class FROM sided WHERE side = 'prod'
), counts AS (SELECT batch, class, count(*) AS n FROM seen GROUP BY ALL
), grid AS (SELECT batch, class FROM (SELECT DISTINCT batch FROM seen) CROSS JOIN (SELECT class FROM ref UNION SELECT class FROM seen)
), compared AS (
  SELECT batch, class, coalesce(n, 0) AS n, coalesce(n, 0)::DOUBLE / sum(n) OVER (PARTITION BY batch) AS share, coalesce(r.share, 0) AS expected,
         count(n) OVER (PARTITION BY batch, class) + count(r.share) OVER (PARTITION BY batch, class) AS known
  FROM grid LEFT JOIN counts USING (batch, class) LEFT JOIN ref r USING (class)
)
SELECT batch, class, n, round(share, 6) AS share, round(expected, 6) AS reference_share, round(share - expected, 6) AS difference,
       round(sum(abs(share - expected)) OVER (PARTITION BY batch) / 2, 6) AS distance FROM compared WHERE known > 0""",
    "duplicated_rows": "SELECT l_orderkey, l_partkey, l_returnflag FROM lineitem "
    "QUALIFY count(*) OVER (PARTITION BY l_orderkey) > 1",
    "average_rank": _OBS
    + "SELECT DISTINCT redshift, count(*) OVER (PARTITION BY redshift) AS n, rank() OVER (ORDER BY redshift) "
    "+ (count(*) OVER (PARTITION BY redshift) - 1) / 2.0::DOUBLE AS avg_rank FROM obs",
    "top_groups": _OBS
    + "SELECT field_id, count(*) AS n, round(count(*)::DOUBLE / (SELECT count(*) FROM obs), 6) AS share FROM obs "
    "GROUP BY field_id ORDER BY n DESC, field_id LIMIT 5",
    "latest_row": _OBS + f"SELECT {_ALL} FROM obs ORDER BY mjd DESC, obj_id DESC LIMIT 1",
    "sample_n": _OBS + f"SELECT obj_id, class, r FROM obs ORDER BY {_md5(SEED, 'obj_id')} LIMIT 1000",
    "group_leak_check": _with(OBS, GROUP_SIDES)
    + "SELECT count(*) AS n_shared FROM (SELECT field_id FROM sides WHERE side = 'train' INTERSECT "
    "SELECT field_id FROM sides WHERE side = 'test')",
    "group_shuffle_split": _with(OBS, GROUP_SIDES) + "SELECT obj_id, field_id, side FROM obs JOIN sides USING (field_id)",
    "strat_group_kfold": _with(OBS, FOLDS) + "SELECT field_id, group_rows, fold FROM folds",
    "temporal_holdout": _with(OBS, CUT) + "SELECT obj_id, mjd, side FROM sided",
    "daily_batches": _with(OBS, CUT)
    + "SELECT obj_id, mjd, (row_number() OVER (ORDER BY mjd, obj_id) - 1) // 2000 + 1 AS batch FROM sided WHERE side = 'prod'",
    "time_order": _OBS + "SELECT obj_id, mjd, row_number() OVER (ORDER BY mjd, obj_id) - 1 AS position FROM obs",
    "append_frames": _with(OBS, CUT)
    + "SELECT class, side, count(*) AS n, round(count(*)::DOUBLE / sum(count(*)) OVER (PARTITION BY side), 6) AS share "
    "FROM sided GROUP BY class, side",
    "row_split": _OBS
    + f"SELECT obj_id, CASE WHEN row_number() OVER (ORDER BY {_md5(SEED, 'obj_id')}) "
    "<= count(*) OVER () - floor(0.15 * count(*) OVER ()) THEN 'train' ELSE 'test' END AS side FROM obs",
    "median_impute": _IMPUTED + f"SELECT obj_id, {_round(FEATURES)} FROM imputed",
    "standard_scale": _scaled("avg({c})", "stddev_pop({c})"),
    "robust_scale": _scaled("median({c})", "(quantile_cont({c}, 0.75) - quantile_cont({c}, 0.25))"),
    "minmax_scale": _scaled("min({c})", "(max({c}) - min({c}))"),
    "label_encode": _OBS
    + "SELECT obj_id, class, (dense_rank() OVER (ORDER BY class) - 1)::INTEGER AS label_code FROM obs",
    "undersample": f"SELECT doc_id, quality, toxic FROM labels QUALIFY row_number() OVER (PARTITION BY toxic ORDER BY "
    f"{_md5(SEED, 'doc_id')}) <= (SELECT min(n) FROM (SELECT count(*) AS n FROM labels GROUP BY toxic))",
    "smote_counts": "WITH sizes AS (SELECT toxic, count(*) AS n FROM labels JOIN documents USING (doc_id) GROUP BY toxic) "
    "SELECT toxic, (SELECT max(n) FROM sizes) AS n, (SELECT max(n) FROM sizes) - n AS n_synthetic FROM sizes",
    "smote_points": _smote(),
    "log_loss": _PRED
    + "SELECT round(-avg(ln(least(greatest([p0, p1, p2][truth + 1], 2.220446049250313e-16), 1 - 2.220446049250313e-16))), 6) "
    "AS log_loss FROM scored",
    "prf_metrics": _with(OBS, PRED, PER_CLASS)
    + "SELECT round(sum(hits) / sum(support), 4) AS accuracy, round(sum(f1 * support) / sum(support), 4) AS f1, "
    'round(sum("precision" * support) / sum(support), 4) AS "precision", '
    "round(sum(recall * support) / sum(support), 4) AS recall FROM prf",
    "auc_ovo": _PRED
    + f", pairs AS ({_pair_auc(0, 1)} UNION ALL {_pair_auc(0, 2)} UNION ALL {_pair_auc(1, 2)}) "
    "SELECT round(sum(auc * w) / sum(w), 6) AS roc_auc FROM pairs",
    "auc_binary": _OBS
    + """, ranked AS (SELECT class = 'O' AS hit, rank() OVER (ORDER BY redshift)
  + (count(*) OVER (PARTITION BY redshift) - 1) / 2.0::DOUBLE AS rk FROM obs)
SELECT round((sum(rk) FILTER (hit) - count(*) FILTER (hit) * (count(*) FILTER (hit) + 1) / 2.0::DOUBLE)
             / (count(*) FILTER (hit)::DOUBLE * count(*) FILTER (NOT hit)), 6) AS auc FROM ranked""",
    "class_report": _with(OBS, PRED, PER_CLASS)
    + """SELECT label, round("precision", 6) AS "precision", round(recall, 6) AS recall, round(f1, 6) AS f1,
       support::BIGINT AS support FROM prf
UNION ALL SELECT 'accuracy', round(sum(hits) / sum(support), 6), round(sum(hits) / sum(support), 6),
       round(sum(hits) / sum(support), 6), sum(support)::BIGINT FROM prf
UNION ALL SELECT 'macro avg', round(avg("precision"), 6), round(avg(recall), 6), round(avg(f1), 6),
       sum(support)::BIGINT FROM prf
UNION ALL SELECT 'weighted avg', round(sum("precision" * support) / sum(support), 6),
       round(sum(recall * support) / sum(support), 6), round(sum(f1 * support) / sum(support), 6),
       sum(support)::BIGINT FROM prf""",
    "confusion": _PRED
    + "SELECT class AS truth, "
    + ", ".join(f"count(*) FILTER (prediction = '{c}') AS pred_{c}" for c in CLASSES)
    + " FROM scored GROUP BY class",
    "argmax_label": _PRED + "SELECT obj_id, code::INTEGER AS code, prediction FROM scored",
    "replay_draws": _with(OBS, CUT)
    + f""", prod AS (SELECT obj_id, mjd, class, row_number() OVER (ORDER BY obj_id) - 1 AS place, count(*) OVER () AS m
  FROM sided WHERE side = 'prod')
SELECT d.range AS draw, p.obj_id, p.mjd, p.class
FROM range((SELECT count(*) FROM prod)) d
JOIN prod p ON p.place = {_number(SEED, 'd.range')} % p.m""",
    "stream_accuracy": _with(OBS, CUT)
    + f""", placed AS (SELECT *, (row_number() OVER (ORDER BY mjd, obj_id) - 1) // 2000 + 1 AS batch FROM sided WHERE side = 'prod'
), ruled AS (SELECT batch, (class = {_RULE.format(r='r', redshift='redshift')})::INT AS hit FROM placed WHERE u <> -9999)
SELECT batch, count(*) AS n, round(avg(hit), 6) AS accuracy, any_value(m) AS n_so_far, round(any_value(a), 6) AS running_accuracy
FROM ruled, (SELECT count(*) AS m, avg(hit) AS a FROM ruled) GROUP BY batch""",
    "rule_importance": _OBS
    + f""", placed AS (
  SELECT obj_id, class, r, redshift, row_number() OVER (ORDER BY {_md5(SEED, 'obj_id')}, obj_id) - 1 AS place, count(*) OVER () AS n FROM obs
), rounds AS (SELECT range AS rep FROM range(10)), exchanged AS (
  SELECT f.feature, rep, p.class, CASE WHEN f.feature = 'r' THEN q.r ELSE p.r END AS r,
         CASE WHEN f.feature = 'redshift' THEN q.redshift ELSE p.redshift END AS redshift
  FROM placed p CROSS JOIN rounds CROSS JOIN (SELECT unnest(['r', 'redshift']) AS feature) f
  JOIN placed q ON q.place = (p.place + {_number(f'{SEED}shift', 'rep')} % (p.n - 1) + 1) % p.n
), scored AS (
  SELECT feature, rep, avg((class = {_RULE.format(r='r', redshift='redshift')})::INT) AS accuracy FROM exchanged GROUP BY ALL
)
SELECT feature, round((SELECT avg((class = {_RULE.format(r='r', redshift='redshift')})::INT) FROM obs) - avg(accuracy), 6) AS importance,
       round(stddev_pop(accuracy), 6) AS deviation FROM scored GROUP BY feature""",
    "rule_folds": _with(OBS, FOLDS, RULE_FOLDS) + "SELECT * FROM fold_metrics",
    "rule_folds_mean": _with(OBS, FOLDS, RULE_FOLDS)
    + "SELECT "
    + ", ".join(f'round(avg("{m}"), 6) AS "{m}"' for m in ("log_loss", "accuracy", "f1", "precision", "recall", "roc_auc"))
    + " FROM fold_metrics",
    "run_log": _OBS
    + f""", classes AS (SELECT class, count(*) AS n FROM obs GROUP BY class)
SELECT 'build' AS run_id, 'data' AS kind, 'dataset_row_count' AS key, count(*)::VARCHAR AS value FROM obs
UNION ALL SELECT 'build', 'data', 'dataset_checksum',
  sum(('0x' || substr(md5(concat_ws(',', {_exact('obj_id')}, {_exact('field_id')}, {_exact('class')})), 1, 8))::BIGINT)::VARCHAR FROM obs
UNION ALL SELECT 'build', 'metrics', 'class_' || class, n::VARCHAR FROM classes
UNION ALL SELECT 'again', 'params', 'seed', '{SEED}' UNION ALL SELECT 'again', 'params', 'scaler', '"robust"'""",
    "quarantine": _OBS
    + "SELECT obj_id, "
    + ", ".join(f"nullif({b}, -9999) AS {b}" for b in BANDS)
    + ", ("
    + " + ".join(f"({b} = -9999)::INTEGER" for b in BANDS)
    + ")::INTEGER AS bad_fields, CASE WHEN least(u, g, r, i, z) = -9999 THEN 'quarantined' ELSE 'ok' END AS status FROM obs",
    "batch_accuracy": _PRED
    + """, placed AS (SELECT *, (row_number() OVER (ORDER BY mjd, obj_id) - 1) // 2000 + 1 AS batch FROM scored)
SELECT batch, count(*) AS n, round(avg((class = prediction)::INTEGER), 6) AS accuracy FROM placed GROUP BY batch""",
}
STATEMENTS["replay_stream"] = STATEMENTS["replay_draws"]
