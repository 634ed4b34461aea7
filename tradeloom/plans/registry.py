"""Named row steps that a configuration can add to a stage."""

from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame

from tradeloom.operators import clean, deadletter, enrich, exposure

Step = Callable[[DataFrame, Mapping], DataFrame]
STEPS: dict[str, Step] = {}


def register(name: str) -> Callable[[Step], Step]:
    """Make ``step(rows, options)`` known under ``name``, which must be new."""

    def add(step: Step) -> Step:
        if name in STEPS:
            raise ValueError(f"a step named {name!r} exists already")
        STEPS[name] = step
        return step

    return add


def step(name: str) -> Step:
    if name not in STEPS:
        raise KeyError(f"no step named {name!r}; there are {names()}")
    return STEPS[name]


def names() -> list[str]:
    return sorted(STEPS)


@register("null_fill")
def _null_fill(rows: DataFrame, options: Mapping) -> DataFrame:
    return clean.null_fill(rows, options)


@register("type_cast")
def _type_cast(rows: DataFrame, options: Mapping) -> DataFrame:
    """Cast rows; those that do not fit go to ``dead_letters`` (path, batch_id), or are left out without it."""
    good, failed = clean.type_cast(rows, options.get("types"))
    if options.get("dead_letters"):
        deadletter.write(failed, options["dead_letters"], "type_cast_failure", options["batch_id"], "TypeCast")
    return good


@register("row_hash")
def _row_hash(rows: DataFrame, options: Mapping) -> DataFrame:
    return clean.row_hash(rows, options.get("name", "row_hash"))


@register("dedup")
def _dedup(rows: DataFrame, options: Mapping) -> DataFrame:
    return clean.dedup(rows, **options)


@register("fx_convert")
def _fx_convert(rows: DataFrame, options: Mapping) -> DataFrame:
    return enrich.fx_convert(rows, **options)


@register("date_expand")
def _date_expand(rows: DataFrame, options: Mapping) -> DataFrame:
    return enrich.date_expand(rows, **options)


@register("lei_lookup")
def _lei_lookup(rows: DataFrame, options: Mapping) -> DataFrame:
    return enrich.lei_lookup(rows, **options)


@register("exposure_rollup")
def _exposure_rollup(rows: DataFrame, options: Mapping) -> DataFrame:
    return exposure.exposure_rollup(rows)


@register("position_net")
def _position_net(rows: DataFrame, options: Mapping) -> DataFrame:
    return exposure.position_net_rows(rows)
