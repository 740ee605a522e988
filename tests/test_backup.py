"""Backups are verified before anything is restored."""

import os

import pytest

from comparo.session import shared_path
from comparo.sources import corpus_store as S

COLUMNS = ("id string, document string, domain string, tld string, length int, price double, platform string, sale_date string, "
           "primary_category string, secondary_category string, desc_index int, has_numbers boolean, embedding array<float>")


def corpus(spark, n=50):
    return spark.createDataFrame([(f"d{i}", f"text {i}\nline", f"x{i}.com", ".com", 3, float(i), "p", "2001-01-01", "A", None,
                                   1, False, [0.5, float(i)]) for i in range(n)], COLUMNS).repartition(3)


def parts(path):
    local = path.removeprefix("file:")
    return sorted(f"{local}/{f}" for f in os.listdir(local) if f.startswith("part-"))


@pytest.fixture
def folder(spark):
    return shared_path(spark, "backup_test")


def rows(df):
    return sorted(map(repr, df.select("id", "document", "price", "embedding").collect()))


def restored(folder):
    local = folder.removeprefix("file:")
    return [f for f in os.listdir(local) if f.startswith("restored_")] if os.path.isdir(local) else []


def test_round_trip_and_manifest(spark, folder):
    path = S.backup_json(corpus(spark), folder)
    assert S.verify_backup(spark, path) and S.latest_backup(spark, folder) == path
    back = spark.read.parquet(S.restore(spark, path, folder))
    assert rows(back) == rows(corpus(spark))
    assert S.read_backup(spark, path).count() == 50
    empty = S.backup_json(corpus(spark, 1).limit(0), folder + "/empty")
    assert spark.read.parquet(S.restore(spark, empty, folder)).count() == 0


@pytest.mark.parametrize("damage", ["lost file", "lost line", "cut line", "changed"])
def test_a_damaged_backup_raises_and_nothing_is_written(spark, folder, damage):
    path = S.backup_json(corpus(spark), folder)
    file = parts(path)[0]
    os.path.exists(f"{os.path.dirname(file)}/.{os.path.basename(file)}.crc") and os.remove(
        f"{os.path.dirname(file)}/.{os.path.basename(file)}.crc")
    text = open(file).read()
    if damage == "lost file":
        os.remove(file)
    else:
        open(file, "w").write({"lost line": text.split("\n", 1)[1], "cut line": text[:-40],
                               "changed": text.replace("text ", "Text ", 1)}[damage])
    with pytest.raises(ValueError, match="manifest"):
        S.restore(spark, path, folder + "/out")
    assert restored(folder + "/out") == []


def test_lines_that_are_no_records_are_set_aside(spark, folder):
    """A backup without a manifest, as other tools write it."""
    local = folder.removeprefix("file:")
    os.makedirs(f"{local}/foreign")
    good = '{"id": "a", "content": "t", "metadata": {"domain": "x.com", "price": 1.5}, "embedding": [1.0]}'
    with open(f"{local}/foreign/lines.json", "w") as f:
        f.write("\n".join([good, '{"id": "b", "content": "cut', "no json", "", '{"content": "no id"}', good.replace('"a"', '"c"')]))
    assert not S.verify_backup(spark, f"{folder}/foreign")
    back = spark.read.parquet(S.restore(spark, f"{folder}/foreign", f"{folder}/out"))
    assert sorted((r.id, r.domain, r.price) for r in back.collect()) == [("a", "x.com", 1.5), ("c", "x.com", 1.5)]
    aside = [f for f in os.listdir(f"{local}/out") if f.startswith("quarantine_")]
    assert sorted(r.value for r in spark.read.text(f"{folder}/out/{aside[0]}").collect()) == [
        "no json", '{"content": "no id"}', '{"id": "b", "content": "cut']
    with pytest.raises(Exception):
        S.read_backup(spark, f"{folder}/foreign").collect()


def test_a_restored_corpus_is_written_compressed(spark, folder):
    path = S.restore(spark, S.backup_json(corpus(spark), folder), folder + "/live")
    assert parts(path) and all(f.endswith(".zstd.parquet") for f in parts(path))


def test_a_packed_backup_is_verified_and_restored(spark, folder, monkeypatch):
    monkeypatch.setattr(S, "PACKED_ROWS", 7)
    path = S.backup_json(corpus(spark), folder, compression="gzip")
    assert len(parts(path)) > 3 and all(f.endswith(".json.gz") for f in parts(path))
    assert S.verify_backup(spark, path) and S.read_backup(spark, path).count() == 50
    assert rows(spark.read.parquet(S.restore(spark, path, folder))) == rows(corpus(spark))
    os.remove(parts(path)[0])
    with pytest.raises(ValueError, match="manifest"):
        S.restore(spark, path, folder + "/out")
