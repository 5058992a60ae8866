from .entities import aws_enis, aws_instances
from .flows import aws_flow_logs, aws_flow_logs_join_ec2, aws_flow_logs_join_enis
from .security import (
    RolePolicy,
    aws_beacon_hours,
    aws_beaconing,
    aws_beaconing_of,
    aws_hourly_resets,
    aws_ioc_connections,
    aws_listed_flows,
    aws_port_scanning,
    aws_port_scanning_of,
    aws_reset_counts,
    aws_rst_baseline,
    aws_rst_baseline_of,
    aws_rst_baseline_of_moments,
    aws_unusual_role_ports,
)

__all__ = [
    "RolePolicy",
    "aws_beacon_hours",
    "aws_beaconing",
    "aws_beaconing_of",
    "aws_enis",
    "aws_flow_logs",
    "aws_flow_logs_join_ec2",
    "aws_flow_logs_join_enis",
    "aws_hourly_resets",
    "aws_instances",
    "aws_ioc_connections",
    "aws_listed_flows",
    "aws_port_scanning",
    "aws_port_scanning_of",
    "aws_reset_counts",
    "aws_rst_baseline",
    "aws_rst_baseline_of",
    "aws_rst_baseline_of_moments",
    "aws_unusual_role_ports",
]
