from .entities import gcp_vms
from .flows import gcp_flow_logs, gcp_flow_logs_join_vms
from .security import (
    gcp_beacon_hours,
    gcp_beaconing,
    gcp_beaconing_of,
    gcp_connect_baseline,
    gcp_connect_baseline_of,
    gcp_connect_baseline_of_moments,
    gcp_hourly_misses,
    gcp_ioc_connections,
    gcp_listed_flows,
    gcp_miss_counts,
    gcp_missed_flows,
    gcp_port_scanning,
    gcp_port_scanning_of,
)

__all__ = [
    "gcp_beacon_hours",
    "gcp_beaconing",
    "gcp_beaconing_of",
    "gcp_connect_baseline",
    "gcp_connect_baseline_of",
    "gcp_connect_baseline_of_moments",
    "gcp_flow_logs",
    "gcp_flow_logs_join_vms",
    "gcp_hourly_misses",
    "gcp_ioc_connections",
    "gcp_listed_flows",
    "gcp_miss_counts",
    "gcp_missed_flows",
    "gcp_port_scanning",
    "gcp_port_scanning_of",
    "gcp_vms",
]
