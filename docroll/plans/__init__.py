"""The reference's jobs as lazy DataFrame plans, and the registered queries."""
