"""The operators as queries over the given tables, with SQL that states the result."""

from __future__ import annotations


def all_checks():
    from checks import column_checks, journey_checks, quality_checks, slot_checks, source_checks, view_checks, voice_checks
    from checks.registry import checks_of

    modules = (
        slot_checks,
        source_checks,
        column_checks,
        view_checks,
        journey_checks,
        quality_checks,
        voice_checks,
    )
    return [check for module in modules for check in checks_of(module)]
