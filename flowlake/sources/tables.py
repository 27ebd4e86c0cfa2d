"""Canonical flat tables of a flow estate, built from the fixture views.

The operators read these shapes; they do not care whether the rows came from
flattened flow documents (``sources.flowdocs``) or from the fixture views.
List values that the fixtures store as ``;``-separated text become arrays here.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.text import split_list
from .fixtures import Fixtures


class Estate:
    """Named flat tables for one scale-factor directory."""

    def __init__(self, fx: Fixtures):
        self.fx = fx

    @classmethod
    def load(cls, spark, sf_dir: str) -> "Estate":
        """Input tables for ``sf_dir`` as lazy plans over the files that are there now."""
        return cls(Fixtures(spark, sf_dir))

    # dimensions -----------------------------------------------------------
    @property
    def groups(self) -> DataFrame:
        return self.fx["fx_group"]

    @property
    def processors(self) -> DataFrame:
        return self.fx["fx_processor"].withColumn(
            "validation_errors", split_list(F.col("validation_errors")))

    @property
    def connections(self) -> DataFrame:
        return self.fx["fx_connection"]

    @property
    def connection_relationships(self) -> DataFrame:
        return self.fx["fx_connection_rel"]

    @property
    def ports(self) -> DataFrame:
        return self.fx["fx_port"]

    @property
    def funnels(self) -> DataFrame:
        return self.fx["fx_funnel"]

    @property
    def labels(self) -> DataFrame:
        return self.fx["fx_label"]

    @property
    def parameters(self) -> DataFrame:
        return self.fx["fx_parameter"]

    @property
    def processor_types(self) -> DataFrame:
        return self.fx["fx_processor_type"]

    @property
    def properties(self) -> DataFrame:
        return self.fx["fx_property"]

    # facts ------------------------------------------------------------------
    @property
    def queue(self) -> DataFrame:
        return self.fx["fx_queue"]

    @property
    def provenance(self) -> DataFrame:
        return self.fx["fx_provenance"]

    @property
    def content(self) -> DataFrame:
        return self.fx["fx_content"]

    @property
    def bulletins(self) -> DataFrame:
        return self.fx["fx_bulletin"]

    # command batches ----------------------------------------------------------
    @property
    def pipeline_specs(self) -> DataFrame:
        return self.fx["fx_pipeline_spec"]

    @property
    def pipeline_names(self) -> DataFrame:
        return self.fx["fx_pipeline_name"]

    @property
    def auto_terminated(self) -> DataFrame:
        return self.fx["fx_auto_terminated"]

    @property
    def commands(self) -> DataFrame:
        return self.fx["fx_command"]

    @property
    def delete_commands(self) -> DataFrame:
        return self.fx["fx_delete_command"]

    @property
    def delete_batch(self) -> DataFrame:
        return self.fx["fx_delete_batch"]

    @property
    def late_queue(self) -> DataFrame:
        return self.fx["fx_late_queue"]

    @property
    def state_commands(self) -> DataFrame:
        return self.fx["fx_state_command"]

    @property
    def config_updates(self) -> DataFrame:
        return self.fx["fx_config_update"]

    @property
    def connection_requests(self) -> DataFrame:
        return self.fx["fx_connection_request"]
