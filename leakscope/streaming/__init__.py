"""Structured Streaming starters: messages -> Bronze, Bronze -> Silver
(per micro-batch or stateful across micro-batches), Silver -> Gold."""
