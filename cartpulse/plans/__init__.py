"""Tables and dashboard queries put together from the operators."""
