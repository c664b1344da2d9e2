"""Co-association statistics."""

from __future__ import annotations

from pyspark.sql import functions as F

from mentionmill import fixed_values as V
from mentionmill.operators import consensus as N
from mentionmill.operators import cooc as O
from mentionmill.operators import stats as S
from mentionmill.plans.registry import query
from mentionmill.plans.views import LABEL, MENTION, STUDY, label, mention, study, weights_sql, with_
from mentionmill.runtime import cut

C = F.col
WEIGHTED = f"weighted AS (SELECT *, {weights_sql(V.MATRIX_WEIGHTS, 0.0)} AS weight FROM study)"
COOC = """cell AS (
  SELECT a, b, papers, raw, 100 * raw / base AS pct FROM (SELECT x.entity AS a, y.entity AS b, count(*) AS papers, sum(weight * weight) AS raw
    FROM mention x JOIN mention y ON x.paper_id = y.paper_id JOIN weighted w ON w.paper_id = x.paper_id WHERE x.category = 'Treatment' AND y.category = 'Cancer' AND weight > 0 GROUP BY 1, 2)
  JOIN (SELECT entity AS e, sum(weight) AS base FROM mention JOIN weighted USING (paper_id) WHERE category = 'Treatment' AND weight > 0 GROUP BY 1) ON e = a
)"""
ALL = with_(MENTION, STUDY, WEIGHTED, COOC)


def studies(spark, d):
    return O.with_weight(study(spark, d), V.MATRIX_WEIGHTS)


def cells(spark, d):
    return O.cooccurrence(mention(spark, d), studies(spark, d), "Treatment", "Cancer")


def rounded(df, *names):
    return df.withColumns({n: F.round(n, 6) for n in names})


@query("J01_study_weight", with_(STUDY, WEIGHTED) + "SELECT paper_id, design, weight FROM weighted")
def j01(spark, d):
    return studies(spark, d).drop("pub_date")


@query("J02_weighted_cooccurrence", ALL + "SELECT a, b, papers, round(raw, 6) AS raw FROM cell")
def j02(spark, d):
    return rounded(cells(spark, d), "raw").drop("pct")


@query("J03_normalised_cooccurrence", ALL + "SELECT a, b, round(pct, 6) AS pct FROM cell")
def j03(spark, d):
    return rounded(cells(spark, d), "pct").select("a", "b", "pct")


LC = "(lgamma({0} + 1) - lgamma({1} + 1) - lgamma({0} - ({1}) + 1))"


def hypergeometric(rows: str) -> str:
    """The two-sided probability of each of ``rows(key, x, r, c, n)``: cell, its margins and the total; sums of all tables no likelier."""
    one = f"{LC.format('r', 'k')} + {LC.format('(n - r)', '(c - k)')} - {LC.format('n', 'c')}"
    return f""", h AS ({rows}), each AS (SELECT key, x, k, {one} AS l FROM (SELECT *, unnest(range(greatest(0, r + c - n), least(r, c) + 1)) AS k FROM h)),
    own AS (SELECT key, l AS lx FROM each WHERE k = x), tested AS (SELECT key, round(least(1.0, sum(exp(l))), 6) AS p FROM each JOIN own USING (key) WHERE l <= lx + 1e-7 GROUP BY key)"""


@query(
    "J04_fisher_reference",
    ALL + ", t AS (SELECT trunc(sum(raw))::BIGINT AS t FROM cell)" + hypergeometric("SELECT x AS key, x, t AS r, t AS c, 3 * t - x AS n FROM (SELECT DISTINCT trunc(raw)::BIGINT AS x FROM cell WHERE raw > 0), t")
    + " SELECT a, b, round(raw, 6) AS raw, coalesce(p, 1.0) AS p FROM cell LEFT JOIN tested ON raw > 0 AND key = trunc(raw)::BIGINT",
)
def j04(spark, d):
    from mentionmill.runtime import ship

    ship(spark)
    return rounded(S.fisher_reference(cells(spark, d)).select("a", "b", "raw", "p"), "raw", "p")


@query(
    "J04_fisher_margins",
    ALL + ", ca AS (SELECT entity AS a, count(*) AS na FROM mention WHERE category = 'Treatment' GROUP BY 1), cb AS (SELECT entity AS b, count(*) AS nb FROM mention WHERE category = 'Cancer' GROUP BY 1)"
    + hypergeometric("SELECT a || '|' || b AS key, papers AS x, na AS r, nb AS c, (SELECT count(DISTINCT paper_id) FROM mention) AS n FROM cell JOIN ca USING (a) JOIN cb USING (b)")
    + " SELECT a, b, papers, p FROM cell JOIN tested ON key = a || '|' || b",
)
def j04m(spark, d):
    from mentionmill.runtime import ship

    ship(spark)
    m = mention(spark, d)
    n = lambda k, name: m.where(C("category") == k).groupBy(C("entity").alias(name)).agg(F.count("*").alias(f"n_{name}"))
    return S.fisher_margins(cells(spark, d), n("Treatment", "a"), n("Cancer", "b"), m.select("paper_id").distinct().count()).select("a", "b", "papers", F.round("p", 6).alias("p"))


def tested(spark, d):
    """A p-value that plain SQL can compute too, so that the adjustment can be compared."""
    return cells(spark, d).withColumn("p", F.round(1 / (1 + C("papers") % 97), 6))


PV = ", pv AS (SELECT *, round(1.0 / (1 + papers % 97), 6) AS p FROM cell), r AS (SELECT *, p * 200 / rank_hi AS q FROM (SELECT *, count(*) OVER (ORDER BY p RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS rank_hi FROM pv)), adj AS (SELECT a, b, papers, p, least(1.0, min(q) OVER (ORDER BY p DESC RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)) AS p_adj FROM r)"


@query("J05_false_discovery", ALL + PV + " SELECT a, b, p, round(p_adj, 6) AS p_adj FROM adj")
def j05(spark, d):
    return rounded(S.benjamini_hochberg(tested(spark, d), 200), "p_adj").select("a", "b", "p", "p_adj")


@query("J06_significant_share", ALL + PV + " SELECT count_if(p <= 0.05) AS n, round(100.0 * count_if(p <= 0.05) / 200, 4) AS pct FROM adj")
def j06(spark, d):
    hits = F.count_if(C("p") <= 0.05)
    return tested(spark, d).agg(hits.alias("n"), F.round(100.0 * hits / 200, 4).alias("pct"))


AGREED = ", agreed AS (SELECT lower(a || ' + ' || b) AS pair, CASE papers % 4 WHEN 0 THEN 'Resistant' WHEN 1 THEN 'No consensus' WHEN 2 THEN 'Sensitive' END AS resolved FROM cell WHERE papers % 5 > 0)"
SIGNED = AGREED + ", signed AS (SELECT a, b, CASE WHEN resolved IS NULL OR resolved = 'No consensus' THEN NULL WHEN resolved = 'Resistant' THEN -abs(round(pct, 6)) ELSE round(pct, 6) END AS score FROM cell LEFT JOIN agreed ON pair = lower(a || ' + ' || b))"


def signed(spark, d):
    c = rounded(cells(spark, d), "pct")
    k = C("papers") % 4
    said = F.when(k == 0, F.lit("Resistant")).when(k == 1, F.lit("No consensus")).when(k == 2, F.lit("Sensitive"))
    agreed = c.where("papers % 5 > 0").select(F.concat_ws(" + ", "a", "b").alias("pair"), said.alias("resolved"))
    return O.signed(c, agreed).select("a", "b", "score")


@query("J07_signed", ALL + SIGNED + " SELECT a, b, score FROM signed")
def j07(spark, d):
    return signed(spark, d)


@query(
    "J08_focus_matrix",
    ALL + SIGNED
    + """, top AS ((SELECT a, b FROM signed WHERE score > 0 ORDER BY score DESC, a, b LIMIT 10) UNION (SELECT a, b FROM signed WHERE score < 0 ORDER BY score, a, b LIMIT 10)
    UNION (SELECT a, b FROM (SELECT *, row_number() OVER (PARTITION BY a ORDER BY abs(score) DESC NULLS LAST, b) AS r FROM signed WHERE a IN ('Brand#1', 'Brand#2')) WHERE r <= 3))
    SELECT s.a, s.b, s.score, round(avg(s.score) OVER (PARTITION BY s.a), 6) AS mean_a FROM signed s WHERE s.a IN (SELECT a FROM top) AND s.b IN (SELECT b FROM top) AND s.score IS NOT NULL""",
)
def j08(spark, d):
    """The rows and columns of the strongest cells and of chosen treatments, with the mean that orders them."""
    s = signed(spark, d)
    forced = O.best_of_each(s.where(C("a").isin("Brand#1", "Brand#2")), "a", 3).select("a", "b")
    top = O.extremes(s, 10).select("a", "b").unionByName(forced).distinct()
    kept = s.join(top.select("a").distinct(), "a", "left_semi").join(top.select("b").distinct(), "b", "left_semi").where("score IS NOT NULL")
    means = kept.groupBy("a").agg(F.round(F.avg("score"), 6).alias("mean_a"))
    return kept.join(means, "a").select("a", "b", "score", "mean_a")


@query("J09_lookup", ALL + SIGNED + " (SELECT a, b, score FROM signed WHERE b = 'SMALL' AND score > 0 ORDER BY score DESC, a LIMIT 20) UNION ALL (SELECT a, b, score FROM signed WHERE b = 'SMALL' AND score < 0 ORDER BY score, a LIMIT 20)")
def j09(spark, d):
    return O.extremes(signed(spark, d).where("b = 'SMALL'"), 20)


@query("J10_top_cells", ALL + "SELECT a, b, papers, round(raw, 6) AS raw, round(pct, 6) AS pct FROM cell ORDER BY round(raw, 6) DESC, a, b LIMIT 50")
def j10(spark, d):
    return O.top_cells(rounded(cells(spark, d), "raw", "pct"), 50)


CONSENSUS = with_(LABEL) + """, c AS (SELECT pair, label, count(*) AS c FROM label GROUP BY pair, label),
  t AS (SELECT pair, sum(c)::BIGINT AS n, count(*) AS kinds, arg_min(label, (-c, label)) AS top, max(c) AS top_n,
    arg_min(label, (-c, label)) FILTER (label IN ('Sensitive', 'Resistant', 'Diagnostic')) AS top_valid, count_if(label IN ('Sensitive', 'Resistant', 'Diagnostic')) AS valid_kinds,
    count_if(label IN ('Unknown', 'Unrelated')) AS weak_kinds, coalesce(sum(c) FILTER (label = 'Unknown'), 0) AS unknown, coalesce(sum(c) FILTER (label = 'Unrelated'), 0) AS unrelated FROM c GROUP BY pair),
  agreed AS (SELECT pair, n, CASE WHEN kinds = 1 OR (top_n >= 0.6 * n AND n >= 3 AND top IN ('Sensitive', 'Resistant', 'Diagnostic')) THEN top
    WHEN valid_kinds = 0 THEN CASE WHEN unrelated > unknown THEN 'Unrelated' ELSE 'Unknown' END WHEN weak_kinds > 0 THEN top_valid ELSE 'No consensus' END AS resolved,
    CASE WHEN kinds = 1 THEN 'hard' WHEN top_n >= 0.6 * n AND n >= 3 AND top IN ('Sensitive', 'Resistant', 'Diagnostic') THEN 'soft' ELSE 'fallback' END AS how FROM t) """


@query("J11_consensus", CONSENSUS + "SELECT pair, n, resolved, how FROM agreed")
def j11(spark, d):
    return N.consensus(label(spark, d))


@query("J12_consensus_key", with_(LABEL) + r"SELECT ord, replace(regexp_replace(lower(variant || '* x-1'), '[^\w\s]', '', 'g'), ' ', '') || ' + ' || lower(treatment) AS key FROM label")
def j12(spark, d):
    return label(spark, d).select("ord", N.pair_key(F.concat("variant", F.lit("* x-1")), C("treatment")).alias("key"))


@query("J13_consensus_summary", CONSENSUS + "SELECT resolved, count(*) AS n, round_even(100.0::DOUBLE * count(*) / sum(count(*)) OVER (), 2) AS pct FROM agreed GROUP BY resolved")
def j13(spark, d):
    return N.summary(N.consensus(label(spark, d)), "resolved")


@query("J14_design_distribution", with_(STUDY) + "SELECT CASE WHEN lower(design) IN ('undefined', 'unmapped', 'behavioral study') THEN 'Other' ELSE design END AS design, count(*) AS n, round_even(100.0::DOUBLE * count(*) / sum(count(*)) OVER (), 2) AS pct FROM study GROUP BY 1")
def j14(spark, d):
    named = F.when(F.lower("design").isin("undefined", "unmapped", "behavioral study"), F.lit("Other")).otherwise(C("design"))
    return N.summary(study(spark, d).select(named.alias("design")), "design")
