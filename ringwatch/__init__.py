"""Market-manipulation analytics as Spark DataFrame operators.

Every operator takes a list of key columns (``keys``) naming the batch a row
belongs to: a micro-batch id, an event-time window start, or any other column.
One job therefore serves any number of batches, in batch and streaming form.
"""
