"""Schemas, readers of the provided tables, adapters to the click-log model, fixed dimensions."""
