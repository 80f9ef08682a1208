"""Job plans: seasons, manifests, resume, registration parameters, clean-up."""
