"""Queries that write staged tables, in a session that says it is a standalone cluster's.

Its checkpoint folder is a ``file:`` one, as where every machine mounts the same disk.
"""

from __future__ import annotations

import os

import pytest

import __spark_entry__ as entry
from salesight.sources import staging

STAGED = [
    "clean_in_batches",
    "cluster_category_counts",
    "cluster_profile",
    "cluster_profile_with_category",
    "cluster_sizes",
    *[f"cube_q{i:02}" for i in range(1, 13)],
    "describe_measures",
    "feature_importance",
    "kmeans_assign",
    "kmeans_elbow",
    "kmeans_facts",
]


@pytest.fixture()
def shared(spark, tmp_path, monkeypatch):
    settings = {"spark.master": "spark://host:7077", "spark.checkpoint.dir": f"file://{tmp_path}"}
    get = type(spark.conf).get
    monkeypatch.setattr(type(spark.conf), "get", lambda self, key, *default: settings.get(key) or get(self, key, *default))
    monkeypatch.setattr(staging, "_marked", set())
    return tmp_path


@pytest.mark.parametrize("name", STAGED)
def test_it_stages_in_the_shared_folder(spark, small_dir, shared, name):
    assert len(entry.queries()[name](spark, small_dir).collect()) > 0
    roots = list(shared.iterdir())
    assert [r.name for r in roots] == [f"salesight-{spark.conf.get('spark.app.id')}"]
    assert os.listdir(roots[0])
