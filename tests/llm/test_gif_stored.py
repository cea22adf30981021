from seatracks.llm import gif_media as G
from seatracks.llm import llm_queries as Q

from .corpus import SCHEMA, rows


def test_media_are_stored_and_reread(spark, tmp_path, monkeypatch):
    docs = spark.createDataFrame(rows(3)[:20], SCHEMA)
    monkeypatch.setattr(Q.common, "load", lambda *_: docs)
    monkeypatch.setattr(Q.common, "shared_dir", lambda *_: str(tmp_path))
    got = {r.doc_id: r.media_sha256 for r in Q.op10_gif_media(spark, "").collect()}
    stored = spark.read.parquet(str(tmp_path / "media"))
    assert stored.columns == ["doc_id", "n_bytes", "media"] and stored.count() == 20
    assert got == {r.doc_id: r.media_sha256 for r in G.media_features(G.store_media(docs)).collect()}
