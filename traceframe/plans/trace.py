"""The whole way from raw records to output events, in the one right order.

Cheap header predicates come first and reach the scan; names are joined only for what
is left; the task filter runs before any payload is decoded; modes without decode have
no join at all.
"""

from __future__ import annotations

from dataclasses import dataclass, field, replace

from pyspark.sql import DataFrame

from traceframe import constants as C
from traceframe.operators import descriptors, filters
from traceframe.operators.decode import decode_payload
from traceframe.operators.extended import decode_extended
from traceframe.operators.manifest import Manifest, attach_manifest, local_table
from traceframe.operators.modes import check_mode, output_mode
from traceframe.schema import PROVIDERS


@dataclass(frozen=True)
class Trace:
    """What to keep of a trace and how to show it."""

    manifest: Manifest
    providers: DataFrame | None = None
    event_ids: tuple = ()
    provider_event_ids: dict = field(default_factory=dict)
    pid_allow: object = None
    pid_deny: object = None
    task_names: tuple = ()
    # Per provider: (descriptors, enabled properties or None); see operators.descriptors.
    provider_params: dict = field(default_factory=dict)
    mode: int = C.MODE_DECODED

    def __post_init__(self):
        check_mode(self.mode)

    def only(self, task: str) -> Trace:
        """This trace without other tasks, so that only ``task`` is decoded. Unknown events stay."""
        if self.task_names and task not in self.task_names:
            return replace(self, task_names=(task,), event_ids=(-1,))
        return replace(self, task_names=(task,))

    def __call__(self, raw: DataFrame) -> DataFrame:
        if self.providers is not None:
            raw = raw.transform(filters.provider_filter(self.providers))
        for provider, (listed, properties) in self.provider_params.items():
            raw = raw.transform(descriptors.provider_params(provider, listed, properties))
        if self.mode == C.MODE_UNFORMATTED:
            return raw.transform(output_mode(self.mode))
        kept = (
            raw.transform(filters.event_id_filter(self.event_ids))
            .transform(filters.provider_event_id_filter(self.provider_event_ids))
            .transform(filters.pid_filter(self.pid_allow, self.pid_deny))
        )
        if self.mode == C.MODE_RAW:
            return kept.transform(output_mode(self.mode))
        return (
            kept.transform(attach_manifest(self.manifest))
            .transform(filters.task_name_filter(self.task_names, self.manifest))
            .transform(decode_payload(self.manifest, tasks=frozenset(self.task_names) or None))
            .transform(decode_extended)
            .transform(output_mode(self.mode))
        )


def preset(
    name: str, manifest: Manifest, task_names=None, use_default_tasks: bool = True,
    level: int | str = C.DEFAULT_LEVEL, any_keywords=None, all_keywords=None, **more,
) -> Trace:
    """A ready capture: ``wininet``, ``process`` or ``rdp``.

    The preset's own task list and an explicit one exclude each other. Keywords may be
    given as names of each provider or as one mask.
    """
    chosen = C.PRESETS[name]
    if task_names is not None and use_default_tasks:
        raise ValueError("give task names or use the default ones, not both")
    tasks = tuple(task_names) if task_names is not None else ()
    rows = [
        (
            title, provider, filters.level_number(level),
            filters.signed_mask(_mask(manifest, provider, any_keywords)),
            filters.signed_mask(_mask(manifest, provider, all_keywords)),
        )
        for title, provider in chosen["providers"]
    ]
    return Trace(
        manifest,
        providers=local_table(manifest.spark, rows, PROVIDERS),
        task_names=chosen["tasks"] if use_default_tasks else tasks,
        **more,
    )


def _mask(manifest: Manifest, provider: str, keywords) -> int:
    from traceframe.operators.manifest import keyword_mask_value

    if isinstance(keywords, int):
        return keywords
    return keyword_mask_value(manifest, provider, keywords) if keywords else 0
