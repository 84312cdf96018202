import os

from relcast.sources.files import read_table
from relcast.spec import TableSpec
from relcast.streaming.file_ingest import glob_regex, stream_ingest

SPEC = TableSpec(name="s", globs=("*_prov.csv",), file_date="data_year", release="release_year",
                 types={"v": "int"}, source_name=True)


def write(folder, name, text):
    os.makedirs(folder, exist_ok=True)
    with open(os.path.join(folder, name), "w") as f:
        f.write(text)


def run(spark, src, target, ckpt):
    q = stream_ingest(spark, SPEC, src, target, checkpoint=ckpt)
    q.awaitTermination()
    assert q.exception() is None
    return sorted((r.v, r._input_file_date.year) for r in read_table(spark, target).collect())


def test_glob_regex():
    assert glob_regex("*_Prov.csv") == r"^.*_Prov\.csv$"


def test_stream_picks_up_only_new_files(spark, tmp_folder):
    src, target, ckpt = f"{tmp_folder}/src", f"{tmp_folder}/t", f"{tmp_folder}/ckpt"
    write(src, "x_r20_d13_prov.csv", "V\n1\n2\n")
    write(src, "ignored.txt", "V\n9\n")
    assert run(spark, src, target, ckpt) == [(1, 2013), (2, 2013)]
    write(src, "x_r20_d14_prov.csv", "V\n3\n")
    assert run(spark, src, target, ckpt) == [(1, 2013), (2, 2013), (3, 2014)]
    assert run(spark, src, target, ckpt) == [(1, 2013), (2, 2013), (3, 2014)]
    write(src, "x_r21_d13_prov.csv", "V\n5\n")  # a newer release restates 2013
    assert run(spark, src, target, ckpt) == [(3, 2014), (5, 2013)]


def test_stream_skips_a_late_older_release(spark, tmp_folder):
    src, target, ckpt = f"{tmp_folder}/src", f"{tmp_folder}/t", f"{tmp_folder}/ckpt"
    write(src, "x_r21_d13_prov.csv", "V\n7\n")
    assert run(spark, src, target, ckpt) == [(7, 2013)]
    write(src, "x_r20_d13_prov.csv", "V\n1\n")  # older release of 2013 arrives later
    assert run(spark, src, target, ckpt) == [(7, 2013)]


def test_a_batch_job_has_loaded_a_newer_release(spark, tmp_folder):
    """The stream's state knows nothing of it; the table does, once."""
    from relcast.plans.jobs import ingest_periods

    src, target, ckpt = f"{tmp_folder}/src", f"{tmp_folder}/t", f"{tmp_folder}/ckpt"
    write(f"{tmp_folder}/batch", "x_r21_d13_prov.csv", "V\n7\n")
    ingest_periods(spark, SPEC, f"{tmp_folder}/batch", target)
    write(src, "x_r20_d13_prov.csv", "V\n1\n")
    write(src, "x_r20_d14_prov.csv", "V\n2\n")
    assert run(spark, src, target, ckpt) == [(2, 2014), (7, 2013)]


def test_the_state_survives_a_restart_and_the_table_is_not_read(spark, tmp_folder, monkeypatch):
    from relcast.streaming import file_ingest

    src, target, ckpt = f"{tmp_folder}/src", f"{tmp_folder}/t", f"{tmp_folder}/ckpt"
    write(src, "x_r21_d13_prov.csv", "V\n7\n")
    assert run(spark, src, target, ckpt) == [(7, 2013)]
    monkeypatch.setattr(file_ingest, "read_table", lambda *_: 1 / 0)
    monkeypatch.setattr(file_ingest, "skip_older_releases", lambda *_: 1 / 0)
    write(src, "x_r20_d13_prov.csv", "V\n1\n")
    assert run(spark, src, target, ckpt) == [(7, 2013)]
    write(src, "x_r22_d13_prov.csv", "V\n8\n")
    write(src, "x_r19_d12_prov.csv", "V\n3\n")
    assert run(spark, src, target, ckpt) == [(3, 2012), (8, 2013)]


def test_releases_behind_the_watermark_are_late(spark, tmp_folder):
    src, target, ckpt = f"{tmp_folder}/src", f"{tmp_folder}/t", f"{tmp_folder}/ckpt"

    def step(name, value):
        write(src, name, f"V\n{value}\n")
        q = stream_ingest(spark, SPEC, src, target, checkpoint=ckpt, late_after="800 days")
        q.awaitTermination()
        assert q.exception() is None
        return sorted((r.v, r._input_file_date.year) for r in read_table(spark, target).collect())

    assert step("x_r16_d13_prov.csv", 1) == [(1, 2013)]
    assert step("x_r21_d14_prov.csv", 2) == [(1, 2013), (2, 2014)]
    # the watermark stands 800 days before release 21; the state of 2013 is gone, and release 15 is late
    assert step("x_r15_d13_prov.csv", 3) == [(1, 2013), (2, 2014)]
    assert step("x_r15_d12_prov.csv", 4) == [(1, 2013), (2, 2014)]
    assert step("x_r20_d13_prov.csv", 5) == [(2, 2014), (5, 2013)]


def test_two_files_of_one_date_in_two_batches(spark, tmp_folder):
    from relcast.specs import FEEDS

    src, target = f"{tmp_folder}/src", f"{tmp_folder}/t"
    for name, npi in (("pending_20240105_physicians.csv", 1), ("pending_20240105_nonphysicians.csv", 2)):
        write(src, name, f"NPI,LAST NAME,FIRST NAME\n{npi},A,B\n")
        q = stream_ingest(spark, FEEDS["pendingilt"], src, target)  # default checkpoint, beside the table
        q.awaitTermination()
        assert q.exception() is None
    assert sorted(r.npi for r in read_table(spark, target).collect()) == ["1", "2"]
    assert os.path.isdir(f"{target}_stream_checkpoint")


def test_loads_that_need_the_whole_feed_are_refused(spark, tmp_folder):
    import pytest

    from relcast.specs import FEEDS

    for name in ("covid19nursinghomes", "optout", "betos"):
        with pytest.raises(ValueError, match="can be streamed"):
            stream_ingest(spark, FEEDS[name], f"{tmp_folder}/src", f"{tmp_folder}/t")
    with pytest.raises(ValueError, match="checkpoint"):
        stream_ingest(spark, SPEC, f"{tmp_folder}/src", "a_table")
