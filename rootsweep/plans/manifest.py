"""Declarative archival manifests.

A manifest says three things:

* which **key sets** a run builds, and how each one is derived from a root
  selection or from another key set (down a foreign key, or up to a parent);
* which **moves** a run makes: every table split into archived / retained rows
  by one of its columns being in one key set;
* which extra **edges** exist that no key set follows (used by orphan audits and
  reachability).

Everything is plain data; the run, the queries and the tests read it.
"""

from __future__ import annotations

from dataclasses import dataclass, field


@dataclass(frozen=True)
class KeySet:
    """One key set (the ids of one entity that a run archives).

    * root:  ``parent is None``: rows of ``table`` whose ``name_col`` is in the
      csv list; carries ``carry`` columns as ``(column, alias)`` pairs.
    * down:  ``fk`` set: rows of ``table`` whose ``fk`` is in ``parent``.
    * up:    ``ref`` set: rows of ``table`` whose ``key`` is named by column
      ``ref`` of the parent (a carried alias on the parent key set, else a
      column of the parent's table).
    """

    name: str
    table: str
    key: str = "id"
    parent: str | None = None
    fk: str | None = None
    ref: str | None = None
    name_col: str | None = None
    carry: tuple[tuple[str, str], ...] = ()

    @property
    def kind(self) -> str:
        if self.parent is None:
            return "root"
        return "up" if self.ref is not None else "down"


@dataclass(frozen=True)
class Move:
    """Split ``table`` by ``column`` in key set ``keyset``; ``pk`` (optional) is
    the table's own key, used by the archive-collision guard."""

    table: str
    column: str
    keyset: str
    pk: str | None = None


@dataclass(frozen=True)
class Edge:
    """Foreign key ``child_table.child_col -> parent_table.parent_col``."""

    child_table: str
    child_col: str
    parent_table: str
    parent_col: str


@dataclass(frozen=True)
class Manifest:
    name: str
    keysets: tuple[KeySet, ...]
    moves: tuple[Move, ...]
    extra_edges: tuple[Edge, ...] = field(default=())

    # ---- lookups -----------------------------------------------------------
    def keyset(self, name: str) -> KeySet:
        for ks in self.keysets:
            if ks.name == name:
                return ks
        raise KeyError(f"unknown key set {name!r} in manifest {self.name!r}")

    def move(self, table: str) -> Move:
        for mv in self.moves:
            if mv.table == table:
                return mv
        raise KeyError(f"table {table!r} is not moved by manifest {self.name!r}")

    @property
    def root(self) -> KeySet:
        roots = [ks for ks in self.keysets if ks.kind == "root"]
        if len(roots) != 1:
            raise ValueError(f"manifest {self.name!r} needs exactly one root key set")
        return roots[0]

    def tables(self) -> list[str]:
        """Every table a run reads, in first-use order."""
        seen: dict[str, None] = {}
        for ks in self.keysets:
            seen.setdefault(ks.table, None)
        for mv in self.moves:
            seen.setdefault(mv.table, None)
        return list(seen)

    def edges(self) -> list[Edge]:
        """Foreign-key edges implied by the key sets and moves, plus extras."""
        out: dict[Edge, None] = {}
        for ks in self.keysets:
            if ks.kind == "down":
                par = self.keyset(ks.parent)
                out.setdefault(Edge(ks.table, ks.fk, par.table, par.key), None)
            elif ks.kind == "up":
                par = self.keyset(ks.parent)
                if par.kind == "root" and any(a == ks.ref for _, a in par.carry):
                    col = next(c for c, a in par.carry if a == ks.ref)
                else:
                    col = ks.ref
                out.setdefault(Edge(par.table, col, ks.table, ks.key), None)
        for mv in self.moves:
            ks = self.keyset(mv.keyset)
            if not (mv.table == ks.table and mv.column == ks.key):
                out.setdefault(Edge(mv.table, mv.column, ks.table, ks.key), None)
        for e in self.extra_edges:
            out.setdefault(e, None)
        return list(out)

    # ---- shape checks ------------------------------------
    def check(self) -> None:
        names = [ks.name for ks in self.keysets]
        if len(set(names)) != len(names):
            raise ValueError("duplicate key set names")
        tables = [mv.table for mv in self.moves]
        if len(set(tables)) != len(tables):
            raise ValueError("a table is moved twice")
        seen: set[str] = set()
        for ks in self.keysets:
            if ks.kind == "root":
                if not ks.name_col:
                    raise ValueError(f"root key set {ks.name!r} needs name_col")
            else:
                if ks.parent not in seen:
                    raise ValueError(f"key set {ks.name!r} comes before its parent {ks.parent!r}")
                if ks.kind == "down" and not ks.fk:
                    raise ValueError(f"key set {ks.name!r} needs fk")
            seen.add(ks.name)
        for mv in self.moves:
            self.keyset(mv.keyset)
        moved = {mv.table for mv in self.moves}
        for ks in self.keysets:
            if ks.table not in moved:
                raise ValueError(f"key set {ks.name!r}: its own table {ks.table!r} is never moved")


# ---------------------------------------------------------------------------
# Manifest over the driver's TPC-H-like tables:
# nation = project (root, by name), region = client (upward, shared),
# customer = encounter, supplier = project-level configuration,
# orders = document, events = other encounter child, lineitem = document child.
# ---------------------------------------------------------------------------
TPCH = Manifest(
    name="tpch",
    keysets=(
        KeySet("projects", "nation", key="n_nationkey", name_col="n_name",
               carry=(("n_regionkey", "client_id"),)),
        KeySet("clients", "region", key="r_regionkey", parent="projects", ref="client_id"),
        KeySet("encounters", "customer", key="c_custkey", parent="projects", fk="c_nationkey"),
        KeySet("configurations", "supplier", key="s_suppkey", parent="projects", fk="s_nationkey"),
        KeySet("documents", "orders", key="o_orderkey", parent="encounters", fk="o_custkey"),
    ),
    moves=(
        Move("lineitem", "l_orderkey", "documents"),
        Move("events", "user_id", "encounters", pk="event_id"),
        Move("orders", "o_orderkey", "documents", pk="o_orderkey"),
        Move("supplier", "s_suppkey", "configurations", pk="s_suppkey"),
        Move("customer", "c_custkey", "encounters", pk="c_custkey"),
        Move("region", "r_regionkey", "clients", pk="r_regionkey"),
        Move("nation", "n_nationkey", "projects", pk="n_nationkey"),
    ),
    extra_edges=(
        Edge("lineitem", "l_suppkey", "supplier", "s_suppkey"),
        Edge("lineitem", "l_partkey", "part", "p_partkey"),
    ),
)

# Second, independent family: documents chosen by `source`, labels follow.
DOCS = Manifest(
    name="docs",
    keysets=(KeySet("docs", "documents", key="doc_id", name_col="source"),),
    moves=(
        Move("labels", "doc_id", "docs"),
        Move("documents", "doc_id", "docs", pk="doc_id"),
    ),
)


# ---------------------------------------------------------------------------
# The reference schema's own manifest: 13 key sets and 73 moves.
# Entity tree, table names, FK columns and step order must equal
# the reference procedure's.
# ---------------------------------------------------------------------------
_REFERENCE_KEYSETS = (
    KeySet("projects", "project_mst", name_col="name", carry=(("client_id", "client_id"),)),
    KeySet("clients", "client_mst", parent="projects", ref="client_id"),
    KeySet("encounters", "encounter_mst", parent="projects", fk="project_id"),
    KeySet("documents", "document_mst", parent="encounters", fk="encounter_id"),
    KeySet("document_codes", "document_code", parent="documents", fk="document_id"),
    KeySet("cm_codes", "cm_code", parent="encounters", fk="encounter_id"),
    KeySet("encounter_dos", "encounter_dos", parent="encounters", fk="encounter_id"),
    KeySet("document_dos", "document_dos", parent="documents", fk="document_id"),
    KeySet("document_evidence", "document_evidence", parent="documents", fk="document_id"),
    KeySet("discussions", "discussion_mst", parent="encounters", fk="encounter_id"),
    KeySet("compliance_gaps", "compliance_gaps", parent="projects", fk="project_id"),
    KeySet("configurations", "configuration_mst", parent="projects", fk="project_id"),
    KeySet("claim_details", "claim_detail", parent="encounters", fk="encounter_id"),
)

# Fixed values: (table, FK column, key set) of the 73 steps, in step order.
_REFERENCE_STEPS = """
document_code_evidence_map document_code_id document_codes
document_code_meat_evidence_map document_code_id document_codes
document_code_combination_map document_code_id document_codes
document_code_hcc_group_map document_code_id document_codes
document_code_cms_hcc_v28_group_map document_code_id document_codes
document_code_hhs_hcc_group_map document_code_id document_codes
document_code_rxhcc_hcc_group_map document_code_id document_codes
document_evidence_coordinates document_evidence_id document_evidence
document_dos_evidence_map document_dos_id document_dos
cm_code_comment cm_code_id cm_codes
cm_code_evidence_map cm_code_id cm_codes
cm_code_history cm_code_id cm_codes
cm_code_meat_evidence_map cm_code_id cm_codes
cm_code_reject_reason_map cm_code_id cm_codes
cm_code_combination_map cm_code_id cm_codes
cm_code_hcc_group_map cm_code_id cm_codes
cm_code_cms_hcc_v28_group_map cm_code_id cm_codes
cm_code_hhs_hcc_group_map cm_code_id cm_codes
cm_code_rxhcc_hcc_group_map cm_code_id cm_codes
cm_code_suppressed_cm_code_map cm_code_id cm_codes
encounter_dos_comment encounter_dos_id encounter_dos
encounter_dos_evidence_map encounter_dos_id encounter_dos
encounter_dos_last_worked encounter_dos_id encounter_dos
encounter_dos_page_range_detail encounter_dos_id encounter_dos
encounter_dos_reject_reason_map encounter_dos_id encounter_dos
encounter_dos_standard_comment encounter_dos_id encounter_dos
discussion_comment discussion_id discussions
discussion_user_map discussion_id discussions
claim_code_map claim_id claim_details
claim_procedure_code_map claim_id claim_details
compliance_gaps_details compliance_gaps_id compliance_gaps
compliance_gaps_evidence_map compliance_gaps_id compliance_gaps
configuration_mst_history configuration_mst_id configurations
document_code document_id documents
document_demographic document_id documents
document_dos document_id documents
document_evidence document_id documents
document_page_detail document_id documents
document_processing_detail document_id documents
document_review_map document_id documents
document_section_map document_id documents
document_sentence document_id documents
genai_processing_detail document_id documents
cm_code encounter_id encounters
encounter_dos encounter_id encounters
encounter_cms_hcc_config_map encounter_id encounters
encounter_event_map encounter_id encounters
encounter_more_specific_less_specific_code_map encounter_id encounters
encounter_nonlegible_page_detail encounter_id encounters
encounter_nonlegible_page_user_map encounter_id encounters
encounter_status_map encounter_id encounters
encounter_status_map_history encounter_id encounters
encounter_suppressed_hcc encounter_id encounters
encounter_trumped_hcc encounter_id encounters
discussion_mst encounter_id encounters
claim_detail encounter_id encounters
codes_backup encounter_id encounters
project_auto_accept_code_config project_id projects
project_compliance_config project_id projects
project_hcc_model_map project_id projects
project_ocr_engine_map project_id projects
project_risk_category_mst project_id projects
user_project_map project_id projects
user_saved_search project_id projects
compliance_gaps project_id projects
configuration_mst project_id projects
client_product_map client_id clients
client_configuration client_id clients
customer_report_download_log client_id clients
document_mst id documents
encounter_mst id encounters
client_mst id clients
project_mst id projects
"""


def _reference_moves() -> tuple[Move, ...]:
    out = []
    for line in _REFERENCE_STEPS.strip().splitlines():
        table, column, keyset = line.split()
        # a primary key is known only for the tables that key sets are built from
        own = any(ks.table == table for ks in _REFERENCE_KEYSETS)
        out.append(Move(table, column, keyset, pk="id" if own else None))
    return tuple(out)


REFERENCE = Manifest(name="reference", keysets=_REFERENCE_KEYSETS, moves=_reference_moves())

MANIFESTS = {m.name: m for m in (TPCH, DOCS, REFERENCE)}
