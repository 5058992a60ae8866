"""The views by name, each built from source tables and other views.

`FlowViews(sources, now)["aws_port_scanning"]` composes the operators down to the
sources. `register` offers all of them to SQL users.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping
from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame, SparkSession

from flowspark import operators as op
from flowspark.sources import cut_lineage, new_kept_path, remove_kept


# Contact with listed addresses: the list meets the parsed flows, and only what it leaves is enriched.
def _aws_ioc(flows: DataFrame, instances: DataFrame, iocs: DataFrame) -> DataFrame:
    listed = op.aws_listed_flows(flows, iocs)
    return op.aws_ioc_connections(op.aws_flow_logs_join_ec2(listed, instances), iocs)


def _azure_ioc(flows: DataFrame, lifetimes: DataFrame, iocs: DataFrame) -> DataFrame:
    listed = op.azure_listed_flows(flows, iocs)
    return op.azure_ioc_connections(op.azure_flow_logs_join_lifetimes(listed, lifetimes), iocs)


def _gcp_ioc(flows: DataFrame, vms: DataFrame, iocs: DataFrame) -> DataFrame:
    return op.gcp_ioc_connections(op.gcp_flow_logs_join_vms(op.gcp_listed_flows(flows, iocs), vms), iocs)


# View: operator, the sources and views it takes in order, and whether it takes `now`.
VIEWS: dict[str, tuple[Callable[..., DataFrame], tuple[str, ...], bool]] = {
    "aws_instances": (op.aws_instances, ("aws_config", "cloudtrail"), True),
    "aws_enis": (op.aws_enis, ("aws_config", "cloudtrail", "aws_instances"), True),
    "aws_flow_logs": (op.aws_flow_logs, ("aws_flow_logs_raw",), False),
    "aws_flow_logs_join_ec2": (op.aws_flow_logs_join_ec2, ("aws_flow_logs", "aws_instances"), False),
    "aws_flow_logs_join_enis": (op.aws_flow_logs_join_enis, ("aws_flow_logs", "aws_enis"), False),
    "aws_beaconing": (op.aws_beaconing, ("aws_flow_logs",), True),
    "aws_ioc_connections": (_aws_ioc, ("aws_flow_logs", "aws_instances", "iocs"), False),
    "aws_reset_counts": (op.aws_reset_counts, ("aws_flow_logs",), True),
    "aws_rst_baseline": (op.aws_rst_baseline_of, ("aws_reset_counts", "aws_instances"), True),
    "aws_port_scanning": (
        op.aws_port_scanning_of,
        ("aws_reset_counts", "aws_instances", "aws_rst_baseline"),
        False,
    ),
    "aws_unusual_role_ports": (op.aws_unusual_role_ports, ("aws_flow_logs_join_ec2",), False),
    "azure_nics": (op.azure_nics, ("azure_logs", "azure_collect_network_interfaces"), True),
    "azure_vms": (op.azure_vms, ("azure_logs", "azure_collect_virtual_machines"), True),
    "azure_vms_nics": (op.azure_vms_nics, ("azure_vms", "azure_nics"), False),
    "azure_flow_logs": (op.azure_flow_logs, ("azure_flow_logs_raw",), False),
    "azure_lifetimes": (op.azure_lifetimes, ("azure_vms_nics",), False),
    "azure_flow_logs_join_vm_nics": (
        op.azure_flow_logs_join_lifetimes,
        ("azure_flow_logs", "azure_lifetimes"),
        False,
    ),
    "azure_ioc_connections": (_azure_ioc, ("azure_flow_logs", "azure_lifetimes", "iocs"), False),
    "azure_denied_counts": (op.azure_denied_counts, ("azure_flow_logs_join_vm_nics",), True),
    "azure_denied_baseline": (op.azure_denied_baseline_of, ("azure_denied_counts", "azure_vms"), True),
    "azure_port_scanning": (op.azure_port_scanning_of, ("azure_denied_counts", "azure_denied_baseline"), False),
    "gcp_vms": (op.gcp_vms, ("gcp_audit_logs", "gcp_cloud_assets"), True),
    "gcp_flow_logs": (op.gcp_flow_logs, ("gcp_audit_logs",), True),
    "gcp_flow_logs_join_vms": (op.gcp_flow_logs_join_vms, ("gcp_flow_logs", "gcp_vms"), False),
    "gcp_beaconing": (op.gcp_beaconing, ("gcp_flow_logs",), True),
    "gcp_ioc_connections": (_gcp_ioc, ("gcp_flow_logs", "gcp_vms", "iocs"), False),
    "gcp_miss_counts": (op.gcp_miss_counts, ("gcp_flow_logs_join_vms",), True),
    "gcp_connect_baseline": (op.gcp_connect_baseline_of, ("gcp_miss_counts", "gcp_vms"), True),
    "gcp_port_scanning": (op.gcp_port_scanning_of, ("gcp_miss_counts", "gcp_connect_baseline"), False),
    "universal_flow_log": (
        op.universal_flow_log,
        ("aws_flow_logs", "gcp_flow_logs", "azure_flow_logs"),
        False,
    ),
}

# Entities are read by several views, and more than once by some; counts by a baseline and the detection against it.
REUSED = (
    "aws_instances",
    "aws_enis",
    "aws_reset_counts",
    "azure_vms",
    "azure_nics",
    "azure_vms_nics",
    "azure_lifetimes",
    "azure_denied_counts",
    "gcp_vms",
    "gcp_miss_counts",
)

# Of these the ones that can be built are views only beside one that reads them.
SERVING = ("aws_reset_counts", "azure_denied_counts", "gcp_miss_counts")


class FlowViews(Mapping[str, DataFrame]):
    """The views that can be built from the given source tables.

    Asking for a view builds its plan. Joins measure their entity side for it, which runs small jobs, and entity views
    are computed then, once, and read back from the session's `spark.checkpoint.dir` by everything above them; with
    `keep_entities=False` they are derived anew wherever they are read and measured. `close`, or leaving a `with` block,
    removes what was kept. `now` is fixed when the views are made, so all of them agree on it.
    `options` are extra arguments per view, such as `{"gcp_flow_logs": {"lookback": "7 days"}}`. The look-back of GCP flows
    is 25 hours here, because the views above it need that much.
    `where` are conditions on views or sources, such as `{"aws_flow_logs": "action = 'ACCEPT' and dstport = 443"}`: everything
    above sees only the rows that meet them, so flows are filtered before they are joined to anything.
    A view may be among the sources, such as one of `EntityDays`; it is then taken as it is.
    """

    def __init__(
        self,
        sources: Mapping[str, DataFrame],
        now: datetime | None = None,
        keep_entities: bool = True,
        options: Mapping[str, dict] | None = None,
        where: Mapping[str, str | Column] | None = None,
    ):
        self._where = dict(where or {})
        self._built = {name: self._kept_rows(name, source) for name, source in sources.items()}
        self._now = now or datetime.now(timezone.utc)
        self._keep_entities = keep_entities
        self._kept: dict[str, SparkSession] = {}
        self._options = {"gcp_flow_logs": {"lookback": "25 hours"}, **(options or {})}
        available = set(sources)
        for name, (_, inputs, _) in VIEWS.items():
            if available.issuperset(inputs):
                available.add(name)
        read = {i for name, (_, inputs, _) in VIEWS.items() if name in available for i in inputs}
        self._names = [name for name in VIEWS if name in available and (name in read or name not in SERVING)]

    def _kept_rows(self, name: str, view: DataFrame) -> DataFrame:
        return view.where(self._where[name]) if name in self._where else view

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._built:
            if name not in self._names:
                raise KeyError(name)
            operator, inputs, timed = VIEWS[name]
            arguments = dict(self._options.get(name, {}))
            if timed:
                arguments["now"] = self._now
            view = self._kept_rows(name, operator(*[self[i] for i in inputs], **arguments))
            if self._keep_entities and name in REUSED:
                path = new_kept_path(view.sparkSession)
                self._kept[path] = view.sparkSession
                view = cut_lineage(view, path)
            self._built[name] = view
        return self._built[name]

    def close(self) -> None:
        """Remove the kept entity views; the views cannot be used any more."""
        for path, spark in self._kept.items():
            remove_kept(spark, path)
        self._kept.clear()

    def __enter__(self) -> FlowViews:
        return self

    def __exit__(self, *_) -> None:
        self.close()

    def __iter__(self):
        return iter(self._names)

    def __len__(self) -> int:
        return len(self._names)

    def register(self, suffix: str = "") -> None:
        """Make every view a temporary view of its name and `suffix`, so that views of several look-backs stand side by side."""
        for name in self:
            self[name].createOrReplaceTempView(name + suffix)
