"""Headline figures that a build over each of the shared test inputs must publish."""

from __future__ import annotations

# FIXED VALUES, from the SQL oracle over the input of that name.
EXPECTED: dict[str, dict[str, str]] = {
    "sf0.001": {"revenue_usd": "4003602634.0947", "cancelled_revenue_usd": "348664441.5000", "sale_lines": "3260"},
    "sf0.01": {"revenue_usd": "40053212297.7823", "cancelled_revenue_usd": "3362601550.2500", "sale_lines": "31842"},
    "sf0.1": {"revenue_usd": "401594037385.5871", "cancelled_revenue_usd": "32869962557.3400", "sale_lines": "319665"},
}
