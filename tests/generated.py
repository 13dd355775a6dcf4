"""Issues that the tests draw, with the counts they imply."""

from __future__ import annotations

import random
from collections import namedtuple
from datetime import datetime, timedelta

T0 = datetime(2024, 6, 1)

ISSUE_COLUMNS = (
    "id string, issue_key string, summary string, description string, status_name string, "
    "priority_name string, issue_type_name string, project_key string, "
    "reporter_display_name string, assignee_display_name string, created timestamp, "
    "updated timestamp, resolution_date timestamp"
)


Issue = namedtuple("Issue", [column.split()[0] for column in ISSUE_COLUMNS.split(", ")])


def generated(count: int, seed: int = 17):
    """Print jobs of a few presses: everything about a job is drawn, but some projects,
    people and states are drawn more often than others."""
    draw = random.Random(seed)
    for i in range(count):
        press = f"PRESS{min(draw.randint(1, 7), draw.randint(1, 7))}"
        status = draw.choice(["Pulled", "Pulled", "Inked", "Drying", "Bound"])
        hand = f"Hand {draw.randint(1, 9)}"
        updated = T0 - timedelta(minutes=30 * draw.randint(0, 40))
        yield Issue(
            f"j{i:04d}", f"{press}-{i}", f"Sheet number {draw.randint(1, 600)}", f"Ink 100% of_{i}", status,
            draw.choice(["Crisis", "Haste", "Mild", "Lull"]), draw.choice(["Blot", "Spread", "Trim", "Edition"]),
            press, hand, hand if draw.random() < 0.4 else None, T0 - timedelta(days=draw.randint(0, 300)),
            updated, updated if status in ("Drying", "Bound") else None,
        )


ISSUES = list(generated(500))


def number(fits) -> int:
    """How many of the generated issues fit."""
    return sum(bool(fits(issue)) for issue in ISSUES)

HISTORY_COLUMNS = (
    "history_id long, issue_id string, issue_key string, change_id string, change_timestamp timestamp, "
    "author_account_id string, author_display_name string, author_email string, field_name string, "
    "field_id string, from_value string, to_value string, from_display_value string, "
    "to_display_value string"
)
