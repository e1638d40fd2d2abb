"""Where stored stages go: the configured folder, the one given by call, a local one on a local master, else an error."""

import os
from types import SimpleNamespace

import pytest

from ratecast import session


def fake(master, conf=None, given=None):
    made = []
    sc = SimpleNamespace(master=master, applicationId="app-1", getCheckpointDir=lambda: given or (made[-1] if made else None),
                         setCheckpointDir=made.append)
    return SimpleNamespace(conf=SimpleNamespace(get=lambda k, d=None: conf or d), sparkContext=sc), made


def test_configured_folder():
    spark, made = fake("spark://x", conf="hdfs://shared/c")
    assert session.shared_dir(spark) == "hdfs://shared/c" and made == ["hdfs://shared/c"]


def test_folder_given_by_call():
    spark, made = fake("spark://x", given="hdfs://shared/d/uuid")
    assert session.shared_dir(spark) == "hdfs://shared/d/uuid" and made == []
    assert session.tables_dir(spark) == "hdfs://shared/d/uuid/tables-app-1"


@pytest.mark.parametrize("master", ["local", "local[4]"])
def test_local_folder_only_on_a_local_master(master):
    spark, made = fake(master)
    d = session.shared_dir(spark)
    assert os.path.isdir(d) and made == [d] and session.shared_dir(spark) == d
    os.rmdir(d)


@pytest.mark.parametrize("master", ["spark://x", "yarn", "local-cluster[2,1,1024]"])
def test_cluster_without_a_shared_folder(master):
    with pytest.raises(RuntimeError):
        session.shared_dir(fake(master)[0])


def test_written_tables_can_be_dropped(spark):
    from ratecast.sources.sinks import sink_replace, table_dir

    path = table_dir(spark, "to_drop", fresh=True)
    assert sink_replace(spark.range(5), path).count() == 5
    session.drop_tables(spark, path.rsplit("/", 1)[1])
    assert not os.path.exists(path.removeprefix("file:"))
