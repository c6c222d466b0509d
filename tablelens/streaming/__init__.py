from .refresh import (
    first_deliveries,
    last_deliveries,
    month_totals,
    refresh_stored,
    run_into,
    week_totals,
)

__all__ = ["first_deliveries", "last_deliveries", "month_totals", "refresh_stored", "run_into", "week_totals"]
