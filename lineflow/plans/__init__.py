"""Flows: steps, composition, registry and the launch plan."""

from lineflow.plans.flow import RECORD, Flow, Step, as_flow, run_frames, run_records
from lineflow.plans.registry import UnknownFlowError, dataflow, lookup, processor, register, registered

__all__ = ["RECORD", "Flow", "Step", "as_flow", "run_frames", "run_records", "UnknownFlowError", "dataflow",
           "lookup", "processor", "register", "registered"]
