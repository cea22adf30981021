"""Messages whose parts lie in several files and triggers; restarts; messages that never end."""

import time

import pytest
from pyspark.sql import functions as F

from seatracks.operators import decode as D
from seatracks.plans import messages as M
from seatracks.shared import shared_dir
from seatracks.streaming import nm4 as ST

from .test_operators import signed

SF = "/root/testdata/sf0.001"


def put(folder, name, *bodies):
    (folder / name).write_text("".join(f"d{b.split(',')[2]} {signed(b)}\n" for b in bodies))


def parts(spark, folder, home, **options):
    return ST.run_available(ST.stream_parts(ST.stream_nm4(spark, str(folder)), **options), str(home))


def seen(df):
    return sorted((r.payload, r.date, r.reject_reason or "") for r in df.collect())


@pytest.fixture()
def folder(tmp_path):
    (tmp_path / "in").mkdir()
    return tmp_path / "in"


def test_parts_in_two_files_of_one_trigger(spark, folder, tmp_path):
    put(folder, "a.txt", "AIVDM,2,1,1,A,aa,0", "AIVDM,3,1,1,B,cc,0")
    put(folder, "b.txt", "AIVDM,2,2,1,A,bb,2", "AIVDM,3,2,1,B,dd,0")
    put(folder, "c.txt", "AIVDM,3,3,1,B,ee,0")
    assert seen(parts(spark, folder, tmp_path / "out")) == [("aabb", "d1", ""), ("ccddee", "d1", "")]


def test_parts_in_two_triggers_and_a_restart(spark, folder, tmp_path):
    put(folder, "a.txt", "AIVDM,3,1,1,A,aa,0")
    assert seen(parts(spark, folder, tmp_path / "out")) == []
    put(folder, "b.txt", "AIVDM,3,2,1,A,bb,0", "AIVDM,1,1,,A,zz,0")
    assert seen(parts(spark, folder, tmp_path / "out")) == []  # a new query each time, from the last one's checkpoint
    put(folder, "c.txt", "AIVDM,3,3,1,A,cc,2", "AIVDM,2,2,1,A,xx,0")
    assert seen(parts(spark, folder, tmp_path / "out")) == [("aabbcc", "d1", ""), ("xx", "d2", ST.ORPHAN)]


def test_open_messages_expire(spark, folder, tmp_path):
    put(folder, "a.txt", "AIVDM,2,1,1,A,aa,0", "AIVDM,2,1,1,B,bb,0")
    parts(spark, folder, tmp_path / "out", ttl_s=1)
    time.sleep(2)
    put(folder, "b.txt", "AIVDM,2,1,1,C,cc,0")
    assert seen(parts(spark, folder, tmp_path / "out", ttl_s=1)) == [("aa", "d1", ST.EXPIRED), ("bb", "d1", ST.EXPIRED)]
    put(folder, "c.txt", "AIVDM,2,2,1,A,late,0")
    assert ("late", "d2", ST.ORPHAN) in seen(parts(spark, folder, tmp_path / "out", ttl_s=1))


def test_broken_messages_and_sources(spark, folder, tmp_path):
    put(folder, "a.txt", "AIVDM,3,1,1,A,aa,0", "AIVDM,3,3,1,A,bb,0", "AIVDM,3,2,1,A,cc,0", "AIVDM,2,1,1,A,dd,0", "AIVDM,2,1,1,A,ee,0", "AIVDM,2,2,1,A,ff,0")
    got = seen(parts(spark, folder, tmp_path / "out"))
    assert got == sorted([("aa", "d1", ST.BROKEN), ("bb", "d3", ST.BROKEN), ("cc", "d2", ST.ORPHAN), ("dd", "d1", ST.RESTARTED), ("eeff", "d1", "")])
    batch = D.assemble(D.verify_sentences(M.read_nm4(spark, str(folder)))[0])
    assert [(r.payload, r.date) for r in batch.collect()] == [("eeff", "d1")]
    (folder / "s1").mkdir()
    (folder / "s2").mkdir()
    put(folder / "s1", "a.txt", "AIVDM,2,1,1,A,gg,0")
    put(folder / "s2", "a.txt", "AIVDM,2,1,1,A,hh,0")
    put(folder / "s1", "b.txt", "AIVDM,2,2,1,A,ii,0")
    put(folder / "s2", "b.txt", "AIVDM,2,2,1,A,jj,0")
    two = ST.run_available(ST.stream_assembled(ST.stream_nm4(spark, str(folder / "s*"))), str(tmp_path / "two"))
    assert sorted(r.payload for r in two.collect()) == ["ggii", "hhjj"]


def test_counts_equal_the_batch_with_one_sentence_a_file(spark, monkeypatch):
    def scattered(spark, d, which="true"):
        home = f"{shared_dir(spark)}/nm4"
        some = M.lines(spark, d).where("line_no < 900").where(which).orderBy("line_no")
        n = some.count()
        some.repartitionByRange(n, "line_no").select(F.concat_ws(" ", "date", "sentence").alias("value")).write.text(home)
        return home

    monkeypatch.setattr(M, "_log_folder", scattered)
    got = {r.key: r.n for r in M.q_stream_histogram(spark, SF).collect()}
    want = D.type_histogram(D.assemble(D.verify_sentences(M.lines(spark, SF).where("line_no < 900"))[0])).collect()
    assert got == {r.key: r.n for r in want} and got["5"] == 15
