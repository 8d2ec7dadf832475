"""Registered queries: columns and types of the contracts, and the check SQL."""

import pytest

import __spark_entry__ as entry
from tests.harness import duck_result, spark_result
from tidemill.llm.queries import QUERIES, SQL

FOLDER = "/root/testdata/sf0.001"
COLUMNS = {
    "op1_simhash": "doc_id bigint, fingerprint string, component_id bigint",
    "op2_packing": "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint, "
                   "sequence_id bigint, offset bigint",
    "op3_decontamination": "doc_id bigint, n_words bigint, n_hit bigint, n_items bigint, "
                           "items_sha256 string, contaminated boolean",
    "op4_language_id": "doc_id bigint, held_out boolean, lang_pred string, score double",
    "op5_license_scan": "doc_id bigint, n_licenses bigint, licenses string, containment double",
    "op6_line_dedup": "doc_id bigint, n_lines bigint, n_dropped bigint, kept_sha256 string",
    "op7_sharding": "doc_id bigint, size bigint, text_crc32 bigint, law string, shard int, "
                    "slot bigint, grown_shard int",
    "op8_exact_dedup": "doc_id bigint, keep_id bigint, group_size bigint, kept boolean, "
                       "text_sha256 string",
    "op9_url_filter": "page_id bigint, host string, path string, rule string, verdict string",
    "op10_pii": "doc_id bigint, n_email bigint, n_ip bigint, n_card bigint, n_phone bigint, "
                "base_sha256 string, spans string",
    "op11_token_counts": "doc_id bigint, n_bytes bigint, n_tokens bigint, over_limit boolean",
    "op12_phrases": "lang string, rank bigint, phrase string, a bigint, l bigint, r bigint, "
                    "n bigint, score bigint",
    "op13_whitening": "vec_id bigint, component int, n bigint, deviation bigint, whitened double, "
                      "explained double, identity_error double",
}


def test_all_operators_and_the_pipeline_are_registered():
    known = entry.queries()
    assert set(COLUMNS) == set(QUERIES) and {*COLUMNS, "pipeline"} <= set(known)
    assert set(SQL) <= set(entry.oracle_sql()) and set(entry.oracle_sql()) <= set(known)


@pytest.mark.parametrize("name", sorted(COLUMNS))
def test_columns_rows_and_check_sql(spark, con, name):
    df = QUERIES[name](spark, FOLDER)
    assert ", ".join(f"{c} {t}" for c, t in df.dtypes) == COLUMNS[name]
    got = spark_result(df)
    if name == "op13_whitening":
        assert len(got[1]) == 4 * con.sql("SELECT count(*) FROM embeddings").fetchall()[0][0]
    elif name not in ("op2_packing", "op12_phrases"):
        table = "pages" if name == "op9_url_filter" else "documents"
        assert len(got[1]) == con.sql(f"SELECT count(*) FROM {table}").fetchall()[0][0]
    if name in SQL:
        assert got == duck_result(con, SQL[name])
