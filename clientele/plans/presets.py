"""The fourteen standard jobs as data.

Table names and ages are fixed values; the database is the caller's. Each job
also has a fixed layout, meant for tables of a few files. By default it is not
applied, so that projection jobs write straight from their scan tasks;
``fixed_layout=True`` brings it back.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from functools import partial

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame

from clientele.functions import AsOf
from clientele.operators import EligibilityRule, add_eligibility, add_full_name, join_on
from clientele.operators.layout import Layout
from clientele.plans.pipeline import Pipeline

# Flag columns and minimum ages.
DRIVE_16 = EligibilityRule("canDrive", 16)
DRIVE_18 = EligibilityRule("canDrive", 18)
VOTE_18 = EligibilityRule("canVote", 18)
DRINK_21 = EligibilityRule("canDrink", 21)
DRIVE_18_TEXT = EligibilityRule("canDrive", 18, yes="Yes", no="No")

CHECKED = (AnalysisException, ValueError)


@dataclass(frozen=True)
class _Job:
    destination: str
    transform: Callable[..., DataFrame]
    layout: Layout
    dated: bool = False  # takes an as-of date
    sources: tuple[str, ...] = ("customers",)
    max_scan_partitions: int | None = None
    tolerates: tuple[type[Exception], ...] = ()


def _flags(
    destination: str,
    *rules: EligibilityRule,
    layout: Layout = 4,
    check: bool = True,
    tolerates: tuple[type[Exception], ...] = (),
) -> _Job:
    transform = partial(add_eligibility, rules=rules, check=check)
    return _Job(destination, transform, layout, dated=True, tolerates=tolerates)


_strict_name = add_full_name
_null_safe_name = partial(add_full_name, sep=" ", null_safe=True)
_gold_orders = partial(join_on, left_key="id", right_key="customer_id", prefix="order_")

# Table names, file counts and tolerated errors.
PRESETS: dict[str, _Job] = {
    "drive18_drink21": _flags("customers_2", DRIVE_18, DRINK_21, tolerates=CHECKED),
    "drive16_tr": _flags("customers_tr", DRIVE_16, tolerates=(Exception,)),
    "vote18_in_place": _flags("customers", VOTE_18),
    "drive16": _flags("customers2", DRIVE_16, tolerates=CHECKED),
    "drive16_vote18": _flags("customers_new", DRIVE_16, VOTE_18, layout=200),
    "drive16_with_age": _flags("customers_with_age", DRIVE_16, layout=8),
    "drive16_in_place": _flags("customers", DRIVE_16),
    "drive_status": _flags("customers_with_drive_status", DRIVE_18_TEXT, check=False),
    "drive_status_again": _flags("customers_with_drive_status", DRIVE_18_TEXT, check=False),
    "full_name_two_files": _Job(
        "customers_transformed", _strict_name, layout=2, max_scan_partitions=4
    ),
    "full_name": _Job("customers_transformed", _strict_name, layout="compact"),
    "full_name_null_safe_in_place": _Job("customers", _null_safe_name, layout="compact"),
    "gold_orders": _Job(
        "gold_orders", _gold_orders, layout="compact", sources=("customers", "orders")
    ),
    "full_name_again": _Job("customers_transformed", _strict_name, layout="compact"),
}


def preset(
    name: str,
    database: str | None = None,
    as_of: AsOf = None,
    rules: tuple[EligibilityRule, ...] | None = None,
    fixed_layout: bool = False,
    staged: bool = True,
    source_database: str | None = None,
    destination_database: str | None = None,
    sources: tuple[str, ...] | None = None,
    destination: str | None = None,
    dob: str = "dob",
) -> Pipeline:
    """A standard job on the tables of ``database``, or from ``source_database`` to
    ``destination_database``. ``rules`` replaces the flag columns of an age job, for
    instance to set other ages; ``dob`` names its birth column; ``sources`` and
    ``destination`` replace the job's table names."""
    job = PRESETS[name]
    read_from, write_to = source_database or database, destination_database or database
    if not read_from or not write_to:
        raise ValueError("Give a database, or one to read from and one to write to.")
    if sources is not None and len(sources) != len(job.sources):
        raise ValueError(f"{name} reads {len(job.sources)} tables: {', '.join(job.sources)}.")
    transform = job.transform
    if job.dated:
        transform = partial(transform, as_of=as_of, dob=dob)
        if rules is not None:
            transform = partial(transform, rules=rules)
    elif rules is not None:
        raise ValueError(f"{name} has no eligibility rules.")
    elif dob != "dob":
        raise ValueError(f"{name} reads no birth column.")
    return Pipeline(
        name=name,
        sources=tuple(f"{read_from}.{s}" for s in sources or job.sources),
        destination=f"{write_to}.{destination or job.destination}",
        transform=transform,
        layout=job.layout if fixed_layout else None,
        max_scan_partitions=job.max_scan_partitions if fixed_layout else None,
        tolerates=job.tolerates,
        staged=staged,
    )
