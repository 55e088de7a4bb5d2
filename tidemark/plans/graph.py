"""Refreshing tables that depend on each other, parents first."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from concurrent.futures import FIRST_COMPLETED, ThreadPoolExecutor, wait
from graphlib import CycleError, TopologicalSorter
from threading import Event

from tidemark.plans.reporting import create_table_as_schema, object_name, object_sql, refresh_table
from tidemark.sources.warehouse import Warehouse
from tidemark.spec import SettingsError, check_table_setting

PARALLEL_REFRESHES = 10


def _key(obj: Mapping) -> str:
    return obj.get("sql_file") or obj["name"]


def _graph_setting(obj: Mapping) -> Mapping | None:
    return (obj.get("table_setting") or {}).get("dag_setting")


def select_objects(objects: Sequence[Mapping]) -> dict[str, Mapping]:
    """Objects that take part in a graph: those with a graph setting, and the parents they name."""
    known = {_key(o): o for o in objects}
    wanted: set[str] = set()
    for key, obj in known.items():
        setting = _graph_setting(obj)
        if setting:
            wanted |= {key, *(setting.get("parents") or ())}
    return {k: o for k, o in known.items() if k in wanted}


def group_objects(objects: Mapping[str, Mapping]) -> dict[str, dict[str, Mapping]]:
    groups: dict[str, dict[str, Mapping]] = {}
    for key, obj in objects.items():
        setting = _graph_setting(obj)
        if not setting or not setting.get("name"):
            raise SettingsError(f"{key!r} is part of a graph but has no dag_setting with a name")
        groups.setdefault(setting["name"].lower().replace(" ", "_"), {})[key] = obj
    return groups


def check_group(name: str, members: Mapping[str, Mapping]) -> tuple[TopologicalSorter, str]:
    """The order of one group, and the frequency its top nodes agree on."""
    order: TopologicalSorter = TopologicalSorter()
    frequencies = set()
    for key, obj in members.items():
        parents = _graph_setting(obj).get("parents") or []
        unknown = [p for p in parents if p not in members]
        if unknown:
            raise SettingsError(f"graph {name!r}: {key!r} names unknown parents {unknown}")
        order.add(key, *parents)
        if not parents:
            frequencies.add(obj["table_setting"].get("load_frequency"))
    try:
        order.prepare()
    except CycleError as err:
        raise SettingsError(f"graph {name!r} has a cycle: {err.args[1]}") from err
    frequencies.discard(None)
    if len(frequencies) != 1:
        raise SettingsError(
            f"graph {name!r}: top objects must agree on one load_frequency, found "
            f"{sorted(frequencies)}")
    return order, frequencies.pop()


def refresh_graph(
    warehouse: Warehouse,
    objects: Sequence[Mapping],
    dataset: str,
    params: Mapping | None = None,
    parallel: int = PARALLEL_REFRESHES,
) -> dict[str, list[str]]:
    """Refresh each table once all its parents are done; independent ones, of one group or of
    several, run side by side.

    Returns the tables of each group in the order they were finished. Groups are checked before
    any of them starts. A failure stops everything not yet started; what was refreshed stays.
    """
    groups = group_objects(select_objects(objects))
    checked = {name: check_group(name, members) for name, members in groups.items()}
    members = {key: obj for group in groups.values() for key, obj in group.items()}
    group_of = {key: name for name, group in groups.items() for key in group}

    failed = Event()

    def run(key: str) -> None:
        if failed.is_set():  # nothing queued starts after a failure
            return
        try:
            refresh(key)
        except Exception:
            failed.set()
            raise

    def refresh(key: str) -> None:
        obj = members[key]
        name, sql = f"{dataset}.{object_name(obj)}", object_sql(obj)
        if not warehouse.table(name).exists():
            layout = check_table_setting(obj["table_setting"])
            create_table_as_schema(warehouse, name, sql, layout, obj.get("description"), params)
        refresh_table(warehouse, name, sql, params)

    done: dict[str, list[str]] = {name: [] for name in groups}
    running = {}
    pool = ThreadPoolExecutor(parallel)
    try:
        while True:
            for order, _ in checked.values():
                for key in order.get_ready():
                    running[pool.submit(run, key)] = key
            if not running:
                return done
            ready, _ = wait(running, return_when=FIRST_COMPLETED)
            for future in ready:
                key = running.pop(future)
                future.result()
                done[group_of[key]].append(key)
                checked[group_of[key]][0].done(key)
    finally:
        pool.shutdown(cancel_futures=True)
