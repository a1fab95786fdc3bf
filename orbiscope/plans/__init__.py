"""Query plans: stages and the catalogue of registered queries."""
