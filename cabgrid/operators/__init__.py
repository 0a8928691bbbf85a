"""Batch operators. Each takes a trips DataFrame and returns a DataFrame."""

from cabgrid.operators.clean import clean_trips
from cabgrid.operators.sequence import with_neighbors
from cabgrid.operators.topk import top_k, top_k_per_group
from cabgrid.operators.routes import route_counts, top_routes, top_routes_per_window
from cabgrid.operators.areas import (
    area_windows,
    empty_taxis,
    area_profit,
    profitable_areas,
    profitable_areas_sql,
    profitable_areas_compat,
)
from cabgrid.operators.idle import idle_gaps, idle_alerts, idle_alert_stretches, idle_compat
from cabgrid.operators.rendezvous import cell_rendezvous, cell_rendezvous_compat
from cabgrid.operators.congestion import congestion_alerts, congestion_compat
from cabgrid.operators.questions import idle_compat_sql, pleasant_drivers_sql, top_routes_sql
from cabgrid.operators.tips import driver_tips, pleasant_drivers, pleasant_drivers_per_day

__all__ = [
    "clean_trips",
    "with_neighbors",
    "top_k",
    "top_k_per_group",
    "route_counts",
    "top_routes",
    "top_routes_per_window",
    "area_windows",
    "empty_taxis",
    "area_profit",
    "profitable_areas",
    "profitable_areas_sql",
    "profitable_areas_compat",
    "idle_gaps",
    "idle_alerts",
    "idle_alert_stretches",
    "idle_compat",
    "cell_rendezvous",
    "cell_rendezvous_compat",
    "congestion_alerts",
    "congestion_compat",
    "driver_tips",
    "pleasant_drivers",
    "pleasant_drivers_per_day",
    "top_routes_sql",
    "idle_compat_sql",
    "pleasant_drivers_sql",
]
