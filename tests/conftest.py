from __future__ import annotations

import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from rootsweep.plans.manifest import KeySet, Manifest, Move  # noqa: E402

SF001 = "/root/testdata/sf0.001"
SF01 = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from rootsweep.session import local_session

    s = local_session(cores="*", shuffle_partitions=8,
                      checkpoint_dir=str(tmp_path_factory.mktemp("ckpt")))
    yield s
    s.stop()


@pytest.fixture()
def scratch(tmp_path):
    return str(tmp_path)


# ---- hand-made micro schema (FIXTURES.md §2) ---------------------------------
MICRO = Manifest(
    name="micro",
    keysets=(
        KeySet("projects", "project", name_col="name", carry=(("client_id", "client_id"),)),
        KeySet("clients", "client", parent="projects", ref="client_id"),
        KeySet("encounters", "encounter", parent="projects", fk="project_id"),
        KeySet("documents", "document", parent="encounters", fk="encounter_id"),
        KeySet("codes", "code", parent="documents", fk="document_id"),
    ),
    moves=(
        Move("code_map", "code_id", "codes", pk="id"),
        Move("code", "document_id", "documents", pk="id"),
        Move("document", "encounter_id", "encounters", pk="id"),
        Move("encounter", "project_id", "projects", pk="id"),
        Move("client_cfg", "client_id", "clients", pk="id"),
        Move("client", "id", "clients", pk="id"),
        Move("project", "id", "projects", pk="id"),
    ),
)

MICRO_DDL = {
    "client": "id bigint",
    "project": "id bigint, name string, client_id bigint",
    "encounter": "id bigint, project_id bigint",
    "document": "id bigint, encounter_id bigint",
    "code": "id bigint, document_id bigint",
    "code_map": "id bigint, code_id bigint",
    "client_cfg": "id bigint, client_id bigint",
}


def base_rows() -> dict[str, list[tuple]]:
    """Two projects A(1) and B(2) with clients 10 and 20, a chain under each."""
    return {
        "client": [(10,), (20,)],
        "project": [(1, "A", 10), (2, "B", 20)],
        "encounter": [(100, 1), (101, 1), (200, 2)],
        "document": [(1000, 100), (1001, 101), (2000, 200)],
        "code": [(5000, 1000), (5001, 1001), (6000, 2000)],
        "code_map": [(7000, 5000), (7001, 5001), (8000, 6000)],
        "client_cfg": [(900, 10), (901, 20)],
    }


def write_tables(spark, root: str, rows: dict[str, list[tuple]], ddl: dict[str, str] = MICRO_DDL) -> str:
    for t, r in rows.items():
        spark.createDataFrame(r, ddl[t]).coalesce(1).write.parquet(f"{root}/{t}")
    return root


@pytest.fixture()
def micro(spark, tmp_path):
    """Factory: write micro tables (base rows, optionally changed) -> input root."""
    def make(**changes):
        rows = base_rows()
        rows.update(changes)
        return write_tables(spark, str(tmp_path / "in"), rows)
    return make


def ids(df, col="id") -> set:
    return {r[col] for r in df.select(col).collect()}
