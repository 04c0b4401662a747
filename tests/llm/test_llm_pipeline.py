import __spark_entry__ as entry
import corpus_pipeline
from corner import documents, empty

from conftest import DATA
from storelens.llm import toxicity as tox
from storelens.llm.shared import write_once
from test_llm_decontam import brute_force as hits_of
from test_llm_near_dup import brute_force as roots_of
from test_llm_packing import PATH, check
from tokenizers import Tokenizer

FOLDER = f"{DATA}/sf0.01"


def test_each_stage_on_what_its_predecessor_kept(spark):
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "near_dup", "decontam", "pii", "packing"]
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    labels = spark.read.parquet(f"{FOLDER}/labels.parquet")
    items = [(r["item_id"], r["text"]) for r in spark.read.parquet(f"{FOLDER}/benchmark.parquet").collect()]
    states = [docs]
    for _, stage in corpus_pipeline.STAGES:
        states.append(write_once(stage(spark, states[-1], FOLDER), "stage"))
        if len(states) < 6:
            assert states[-1].columns == docs.columns
    ids = [{r["doc_id"] for r in s.select("doc_id").collect()} for s in states]
    lexicon = tox.fit(docs, labels)
    toxic = {r["doc_id"] for r in tox.toxicity(docs, lexicon).where("predicted = 1").collect()}
    assert ids[1] == ids[0] - toxic and toxic
    rows = [[(r["doc_id"], r["text"]) for r in s.collect()] for s in states[:5]]
    roots, _ = roots_of(rows[1], 80)
    assert ids[2] == set(roots.values()) and ids[2] < ids[1]
    assert ids[3] == {r[0] for r in hits_of(rows[2], items) if not r[5]} and ids[3] < ids[2]
    assert ids[4] == ids[3] and dict(rows[4]) != dict(rows[3])
    assert all(r["n_chars"] == len(r["text"]) for r in states[4].collect())
    check(states[5].collect(), dict(rows[4]), Tokenizer.from_file(PATH), 4096)


def test_registered_run_reads_its_tables(spark):
    rows = entry.queries()["pipeline"](spark, FOLDER).collect()
    assert {"doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"} == set(rows[0].asDict())


def test_stages_bear_corner_rows(spark):
    for docs in (documents(spark), empty(spark)):
        for _, stage in corpus_pipeline.STAGES:
            assert stage(spark, docs, FOLDER).count() >= 0
