import collections
import hashlib
import struct
import subprocess
import sys
from pathlib import Path

import public_tokenizers
import pytest
import tiktoken
from pyspark.sql import functions as F

import corpus_pipeline
from bandstand.llm.merges import read_ranks
from bandstand.llm.near_text import NearText
from bandstand.llm.queries import ORACLE, QUERIES
from bandstand.llm.registry import table
from test_near import brute_text

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    """What each stage kept, written and read again like the next stage's input."""
    kept = [table(spark, FOLDER, "documents")]
    for name, stage in corpus_pipeline.STAGES:
        path = str(tmp_path_factory.mktemp("stage") / name)
        stage(spark, kept[-1], FOLDER).write.parquet(path)
        kept.append(spark.read.parquet(path))
    return kept


def test_each_stage_does_its_work(stages):
    before, language, lines, near, mix, encoded = stages
    assert all(x.columns == before.columns for x in (language, lines, near, mix))
    letters = before.where(F.col("text").rlike(r"\p{L}"))
    assert language.exceptAll(letters).count() == letters.exceptAll(language).count() == 0
    texts = {r.doc_id: r.text for r in language.collect()}
    seen = collections.Counter(k for t in texts.values() for k in {x.strip(" \t\n\x0b\x0c\r").lower() for x in t.split("\n")})
    short = {r.doc_id: r.text for r in lines.collect()}
    assert set(short) == set(texts) and any(short[d] != texts[d] for d in texts)
    assert not [d for d, t in short.items() for x in t.split("\n") if x.strip() and seen[x.strip(" \t\n\x0b\x0c\r").lower()] >= 10]
    want = {d for d, _, _, kept in brute_text(sorted(short.items()), NearText()) if kept}
    assert {r.doc_id for r in near.select("doc_id").collect()} == want and near.count() == len(want)
    copies = collections.Counter(r.doc_id for r in mix.select("doc_id").collect())
    assert set(copies) <= want and max(copies.values()) <= 3
    ranks = read_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken"))
    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    assert collections.Counter(r.doc_id for r in encoded.select("doc_id").collect()) == copies
    for r in encoded.dropDuplicates(["doc_id"]).collect():
        ids = library.encode_ordinary(short[r.doc_id])
        assert r.ids_sha256 == hashlib.sha256(struct.pack(f"<{len(ids)}I", *ids)).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(short[r.doc_id].encode()).hexdigest()


def test_every_operator_has_a_query():
    assert sorted(int(q[2:].split("_")[0]) for q in QUERIES) == list(range(1, 14)) and set(ORACLE) <= set(QUERIES)


def test_the_rest_works_without_this_subpackage():
    code = """
import sys
class Gone:
    def find_spec(self, name, path=None, target=None):
        if name.split(".")[0] == "corpus_pipeline" or name.startswith("bandstand.llm"):
            raise ModuleNotFoundError(name, name=name)
sys.meta_path.insert(0, Gone())
import __spark_entry__ as e
assert "mart_subgenre_health" in e.queries() and not [q for q in e.queries() if q.startswith("op") or q == "pipeline"]
assert set(e.oracle_sql()) <= set(e.queries())
"""
    root = Path(__file__).resolve().parents[2]
    done = subprocess.run([sys.executable, "-c", code], cwd=root, capture_output=True, text=True, timeout=100)
    assert done.returncode == 0, done.stderr


def test_without_learned_languages_lettered_documents_stay(spark, clashing):
    unnamed = clashing.withColumn("lang", F.lit(None).cast("string"))
    kept = corpus_pipeline.identify_language(spark, unnamed, FOLDER)
    want = unnamed.where(F.col("text").rlike(r"\p{L}"))
    assert kept.columns == unnamed.columns and kept.exceptAll(want).count() == want.exceptAll(kept).count() == 0
    assert want.count() > 0 and corpus_pipeline.identify_language(spark, unnamed.where("false"), FOLDER).count() == 0


def test_last_stage_of_clashing_and_empty_tables(spark, clashing):
    assert corpus_pipeline.encode(spark, clashing, FOLDER).count() == clashing.count()
    assert corpus_pipeline.encode(spark, clashing.where("false"), FOLDER).count() == 0
