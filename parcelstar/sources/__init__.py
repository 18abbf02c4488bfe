"""Reading and landing of the raw zone, the staging zone and the warehouse."""
