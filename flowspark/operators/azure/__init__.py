from .entities import azure_nics, azure_vms, azure_vms_nics
from .flows import (
    azure_flow_logs,
    azure_flow_logs_join_lifetimes,
    azure_flow_logs_join_vm_nics,
    azure_lifetimes,
)
from .security import (
    azure_denied_baseline,
    azure_denied_baseline_of,
    azure_denied_baseline_of_moments,
    azure_denied_counts,
    azure_denied_flows,
    azure_denied_records,
    azure_hourly_denied,
    azure_ioc_connections,
    azure_listed_flows,
    azure_port_scanning,
    azure_port_scanning_of,
)

__all__ = [
    "azure_denied_baseline",
    "azure_denied_baseline_of",
    "azure_denied_baseline_of_moments",
    "azure_denied_counts",
    "azure_denied_flows",
    "azure_denied_records",
    "azure_flow_logs",
    "azure_flow_logs_join_lifetimes",
    "azure_flow_logs_join_vm_nics",
    "azure_hourly_denied",
    "azure_ioc_connections",
    "azure_lifetimes",
    "azure_listed_flows",
    "azure_nics",
    "azure_port_scanning",
    "azure_port_scanning_of",
    "azure_vms",
    "azure_vms_nics",
]
