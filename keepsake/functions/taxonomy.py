"""Which clickstream events mean what, as data.

A rule compares plain columns with literals only, so that the predicates reach the Parquet scan.
Event names are expected in the form the bronze step writes (single spaces, trimmed); the two
spellings with and without a space after the colon are both accepted everywhere.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Rule:
    """``events`` and every ``where`` entry must match, and one entry of ``any_of`` if given."""

    events: tuple[str, ...]
    where: dict[str, tuple[str, ...]] = field(default_factory=dict)
    any_of: dict[str, tuple[str, ...]] = field(default_factory=dict)

    def match(self, event: str = "event") -> Column:
        tests = [F.col(event).isin(*spellings(*self.events))]
        tests += [F.col(c).isin(*values) for c, values in self.where.items()]
        if self.any_of:
            options = [F.col(c).isin(*values) for c, values in self.any_of.items()]
            tests.append(reduce(lambda a, b: a | b, options))
        return reduce(lambda a, b: a & b, tests)


def spellings(*events: str) -> list[str]:
    """Both spellings of each ``family: action`` name."""
    names = []
    for event in events:
        family, action = (part.strip() for part in event.split(":", 1))
        names += [f"{family}: {action}", f"{family}:{action}"]
    return names


OBJECT = "properties_object_detail"
DETAIL = "properties_ui_object_detail"
ACCESS_POINT = "properties_ui_access_point"
SCREEN = "properties_screen"

# Access points inside the cancel flow.
CANCEL_FLOW_ACCESS_POINTS = (
    "CancelFlowBillingCancel",
    "CancelFlowTalkToExpert",
    "AccountSettingsCancel",
    "MobileAppBillingCancel",
    "CancelFlowBillingPage",
    "MobileAppCancelSupport",
)

# Event taxonomy.
INITIATION = Rule(
    ("workflow: started",),
    {OBJECT: ("cancel", "cancellation_workflow"), DETAIL: ("cancel_subscription", "cancel")},
)
CONFIRMATION_BY_GENERATION = {
    3: Rule(("workflow: completed",), {OBJECT: ("cancel",), DETAIL: ("cancel_success",)}),
    2: Rule(
        ("workflow: engaged", "widget: engaged"),
        {OBJECT: ("cancellation_workflow", "cancel"), DETAIL: ("yes_cancel",)},
    ),
    1: Rule(
        ("cancelation flow: viewed",),
        {ACCESS_POINT: ("cancel success",)},
        {SCREEN: ("cancel complete",), OBJECT: ("canceled", "cancel trowser")},
    ),
}
UPGRADE = Rule(("workflow: completed",), {OBJECT: ("upgrade",), DETAIL: ("get_started",)})
DOWNGRADE = Rule(("workflow: completed",), {OBJECT: ("downgrade",), DETAIL: ("get_started",)})
OFFER_VIEWED = Rule(("offer: viewed",), {ACCESS_POINT: CANCEL_FLOW_ACCESS_POINTS})
OFFER_CLICKED = Rule(("offer: clicked",), {ACCESS_POINT: CANCEL_FLOW_ACCESS_POINTS})
USAGE_WIDGET_VIEWED = Rule(("content: viewed",), {OBJECT: ("usage-highlights-widget",)})

# Names admitted by the stream.
STREAM_EVENTS = (
    "workflow: started",
    "workflow: completed",
    "workflow: engaged",
    "widget: engaged",
    "offer: viewed",
    "offer: clicked",
    "content: viewed",
    "cancelation flow: viewed",
)


def is_stream_event(event: str = "event") -> Column:
    return F.col(event).isin(*spellings(*STREAM_EVENTS))


def confirmation_generation() -> Column:
    """3, 2 or 1 for a confirmation event, NULL for any other: one scan instead of a union of three."""
    return F.coalesce(
        *[F.when(rule.match(), F.lit(gen)) for gen, rule in CONFIRMATION_BY_GENERATION.items()]
    )


def is_confirmation() -> Column:
    return reduce(lambda a, b: a | b, [r.match() for r in CONFIRMATION_BY_GENERATION.values()])


def milestone() -> Column:
    """Kind of a cancel-flow event: initiation, confirmation, upgrade, downgrade, offer, widget."""
    return F.coalesce(
        F.when(INITIATION.match(), F.lit("initiation")),
        F.when(is_confirmation(), F.lit("confirmation")),
        F.when(UPGRADE.match(), F.lit("upgrade")),
        F.when(DOWNGRADE.match(), F.lit("downgrade")),
        F.when(OFFER_VIEWED.match(), F.lit("offer_viewed")),
        F.when(OFFER_CLICKED.match(), F.lit("offer_clicked")),
        F.when(USAGE_WIDGET_VIEWED.match(), F.lit("widget_viewed")),
    )


def is_flow_event() -> Column:
    """Any cancel-flow event; a disjunction of IN lists, which the Parquet reader can use."""
    names = spellings(
        *INITIATION.events,
        *(e for r in CONFIRMATION_BY_GENERATION.values() for e in r.events),
        *UPGRADE.events,
        *OFFER_VIEWED.events,
        *OFFER_CLICKED.events,
        *USAGE_WIDGET_VIEWED.events,
    )
    return F.col("event").isin(*dict.fromkeys(names))
