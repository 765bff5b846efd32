"""Positional layouts of the input files.

A layout is a tuple of (target column, source) where the source is a 1-based file
position, ``None`` for a null column or ``=text`` for a constant. ``rtrim`` positions are
listed separately.
"""

from __future__ import annotations

from dataclasses import dataclass

from .. import fixed_values as fv

# The fourteen lead columns in file order.
LEAD_COLUMNS = (
    "first_name", "last_name", "email", "phone_number", "age", "address", "apartment_no", "city",
    "state", "zip_code", "patient_consent", "channel", "submission_timestamp", "file_date",
)
LEAD_FILE_PATTERN = "*prospect_campaign_*.csv"

_EVENT = (
    "account_id", "oyb_account_id", "job_id", "list_id", "batch_id", "subscriber_id", "subscriber_key",
    "event_date", "domain", "triggered_send_customer_key", "triggered_send_def_object_id",
)
_SNAPSHOT = (
    "prospect_id", "first_name", "last_name", "email_address", "marketing_consent", "high_engagement",
    "registration_date", "last_updated",
)
_JOURNEY = ("prospect_id", "welcome_journey_complete", "nurture_journey_complete", "suppression_flag") + tuple(
    c for s in fv.STAGES for c in (f"{s[4]}_sent", f"{s[4]}_sent_date")
)


@dataclass(frozen=True)
class Layout:
    columns: tuple[tuple[str, int | str | None], ...]
    width: int
    rtrim: tuple[str, ...] = ()
    integers: tuple[str, ...] = ()


def _in_order(names: tuple[str, ...], *constants: tuple[str, str]) -> Layout:
    columns = tuple((n, i + 1) for i, n in enumerate(names)) + tuple((n, f"={v}") for n, v in constants)
    ints = tuple(n for n in names if n in ("job_id", "list_id", "batch_id", "subscriber_id"))
    return Layout(columns, len(names), integers=ints)


# File positions per entity.
LAYOUTS: dict[str, Layout] = {
    "sent": Layout(
        (("account_id", 1), ("oyb_account_id", 7), ("job_id", 5), ("list_id", 6), ("batch_id", 2),
         ("subscriber_id", 8), ("subscriber_key", 9), ("event_date", 4), ("domain", 3),
         ("triggered_send_customer_key", 10), ("triggered_send_def_object_id", 11), ("record_type", "=SENT")),
        11, integers=("job_id", "list_id", "batch_id", "subscriber_id"),
    ),
    "opens": _in_order((*_EVENT, "is_unique"), ("record_type", "OPEN")),
    "clicks": _in_order((*_EVENT, "is_unique", "url", "link_name", "link_content"), ("record_type", "CLICK")),
    "bounces": _in_order((*_EVENT, "bounce_category", "bounce_type", "smtp_bounce_reason"), ("record_type", "BOUNCE")),
    "unsubscribes": Layout(
        (("account_id", 1), ("subscriber_key", 7), ("job_id", 3), ("event_date", 8), ("reason", None),
         ("record_type", "=UNSUBSCRIBE")),
        10, integers=("job_id",),
    ),
    "spam": Layout(
        (("account_id", 1), ("subscriber_key", 2), ("job_id", 3), ("event_date", 4), ("complaint_type", 5),
         ("record_type", "=SPAM")),
        5, integers=("job_id",),
    ),
    "job_metadata": Layout(
        (("job_id", 1), ("journey_type", None), ("mapped_stage", None), ("email_name", 16),
         ("email_subject", 17), ("record_type", "=JOB")),
        42, rtrim=("email_subject",), integers=("job_id",),
    ),
    "job_detail": Layout(
        tuple([("job_id", 1)] + [(f"field_{i:02d}", i) for i in range(2, 16)]
              + [("email_name", 16), ("email_subject", 17)] + [(f"field_{i:02d}", i) for i in range(18, 43)]),
        42, rtrim=("email_subject",),
    ),
    "unsubscribe_detail": _in_order((
        "account_id", "oyb_account_id", "job_id", "list_id", "batch_id", "subscriber_id", "subscriber_key",
        "event_date", "is_unique", "domain",
    )),
    "prospect_snapshot": _in_order(_SNAPSHOT),
    "prospect_history": Layout(
        tuple((n, i + 1) for i, n in enumerate((*_SNAPSHOT, "batch_id", "job_id"))), 10
    ),
    "journey_details": _in_order(_JOURNEY),
}
GENERIC_WIDTH = 50
