"""Multi-step plans put together from the operators."""
