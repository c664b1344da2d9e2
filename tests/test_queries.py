"""Queries against their SQL on the smallest tables, one or two of each family."""

import math
import os

import duckdb
import pytest

from mentionmill.plans import registry

DATA = os.environ.get("MENTIONMILL_TESTDATA", "/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not os.path.isdir(DATA), reason="no test tables")
NAMES = [
    "A01_scan_schema", "A02_panel_list", "A07_dimension_source", "A08_enrichment_fallback", "A09_nested_json", "A12_csv_sink", "A13_chunked_csv", "A14_csv_append", "A16_graph_file", "A10_inverted_text", "A17_batches", "B15_not_research", "D04_substring_match", "D09_variant_patterns", "D18_candidate_pairs", "G06_histogram_pivot", "I11_sample", "L08_node_size", "B07_title_prefix", "B20_funnel", "C08_clean_cancer_term", "C16_clean_pairs", "D01_dictionary_match", "D07_windows", "D10_response_pairs", "D20_nearest_vectors",
    "E01_one_hot_fixed", "E11_merged_aliases", "F02_full_outer_chain", "G14_percentile", "G18_rollup", "H01_centred_mean", "H07_false_discovery", "I01_sorted", "I04_submatrix", "J03_normalised_cooccurrence", "J04_fisher_reference", "J04_fisher_margins",
    "J11_consensus", "K01_per_period", "K06_panel_coverage", "L04_neighbours", "L05_degree", "L07_components", "L13_network_query", "M03_set_confusion", "M08_weighted_scores", "N01_parent_chain",
    "A18_reassembled_parts", "B06_rejected_rows", "B16_blocked_abstract", "C01_clean_text", "C02_repaired", "D01_table_function", "D06_union_of_taggers", "F17_as_of", "F17_as_of_by_customer", "F17_intervals", "H09_order_of_all", "J15_modularity",
    "L07_induced_edges", "L07_dropped_vertices", "L10_unmatched", "M03_first_errors", "M06_disagreeing_rows",
]


@pytest.fixture(scope="module")
def sql():
    con = duckdb.connect()
    for t in "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split():
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{DATA}/{t}.parquet'")
    return con


def plain(v):
    if isinstance(v, (list, tuple)):
        return tuple(plain(x) for x in v)
    return "nan" if isinstance(v, float) and math.isnan(v) else v


@pytest.mark.parametrize("name", NAMES)
def test_equals_sql(spark, sql, name):
    df = registry.queries()[name](spark, DATA)
    columns = sorted(df.columns)
    got = sorted((tuple(plain(v) for v in r) for r in df.select(*[f"`{c}`" for c in columns]).collect()), key=str)
    told = sql.execute(registry.oracle_sql()[name])
    order = [c[0] for c in told.description]
    want = sorted((tuple(plain(r[order.index(c)]) for c in columns) for r in told.fetchall()), key=str)
    assert sorted(order) == columns and got == want


def test_every_query_is_registered_once():
    assert len(registry.queries()) > 200 and set(registry.oracle_sql()) <= set(registry.queries())
