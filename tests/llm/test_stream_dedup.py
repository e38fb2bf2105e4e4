import hashlib
import re

import pytest

from chronogrid.llm.common import work_dir
from chronogrid.llm.stream_dedup import exact_dedup


def expected(rows):
    norm = lambda t: re.sub(r"[\x20\x09-\x0D]+", " ", t or "")
    groups = {}
    for i, t in rows:
        groups.setdefault(norm(t), []).append(i)
    return sorted((i, min(groups[norm(t)]), len(groups[norm(t)]), hashlib.sha256(norm(t).encode()).hexdigest()) for i, t in rows)


@pytest.mark.parametrize(("files", "digest_hex"), [(10_000, 64), (1, 64), (2, 1)])
def test_against_brute_force(spark, docs, corpus, files, digest_hex):
    """A digest of one hex digit has collisions everywhere: only the full texts keep groups apart."""
    path = work_dir(spark, "t")
    docs.write.mode("overwrite").parquet(path)
    got = exact_dedup(spark, path, files_per_batch=files, digest_hex=digest_hex).collect()
    assert sorted((r.doc_id, r.keep_id, r.group_size, r.text_sha256) for r in got) == expected(corpus)
    kept = [r for r in got if r.kept]
    assert len(kept) == len({r.text_sha256 for r in got}) and all(r.doc_id == r.keep_id for r in kept)


def test_null_ids_and_empty_table(spark, empty):
    path = work_dir(spark, "t")
    spark.createDataFrame([(None, "a"), (5, "a"), (None, "b")], "doc_id long, text string").write.mode("overwrite").parquet(path)
    got = {(r.doc_id, r.keep_id, r.group_size, r.kept) for r in exact_dedup(spark, path).collect()}
    assert got == {(None, 5, 2, False), (5, 5, 2, True), (None, None, 1, True)}
    path = work_dir(spark, "t")
    empty.write.mode("overwrite").parquet(path)
    assert exact_dedup(spark, path).collect() == []


@pytest.mark.parametrize("name", ["plain/", "a[b]c{d}*", "x?y", "ends]"])
def test_paths_of_any_characters(spark, docs, corpus, tmp_path, name):
    """Neighbours that a pattern would match are not read."""
    (tmp_path / "other").mkdir()
    for other in ("abc", "xzy", "end", "plai"):
        spark.createDataFrame([(1, "stray")], "doc_id long, text string").write.parquet(str(tmp_path / other))
    import shutil

    source = work_dir(spark, "t")
    docs.write.mode("overwrite").parquet(source)
    shutil.copytree(source.removeprefix("file:"), tmp_path / name.rstrip("/"))
    got = exact_dedup(spark, f"{tmp_path}/{name}").collect()
    assert sorted((r.doc_id, r.keep_id, r.group_size, r.text_sha256) for r in got) == expected(corpus)


def test_state_is_hit_by_later_batches(spark):
    """Copies that come in a later micro-batch, one by one, with smaller ids and with greater ones."""
    path = work_dir(spark, "t")
    rows = [(k, f"text  {k % 3}" if k % 2 else f"text {k % 3}") for k in range(12)]
    for k in range(12):
        spark.createDataFrame([rows[-k]], "doc_id long, text string").coalesce(1).write.mode("append").parquet(path)
    for files in (None, 1, 5):
        got = exact_dedup(spark, path, files_per_batch=files).collect()
        assert sorted((r.doc_id, r.keep_id, r.group_size, r.text_sha256) for r in got) == expected(rows)


def test_texts_are_masked_only_where_no_digest_is_hit(spark):
    from chronogrid.llm.stream_dedup import _only_texts_of

    rows = [(f"{k:064x}", f"t{k}") for k in range(2000)]
    docs = spark.createDataFrame(rows, "digest string, text string")
    hits = docs.where("text LIKE '%7'").select("digest")
    got = {r.digest: r.text for r in _only_texts_of(docs, hits).collect()}
    assert all(got[d] == t for d, t in rows if t.endswith("7")) and len(got) == 2000
    assert sum(t is None for t in got.values()) > 1500
