"""Association rules, clustering, classification and regression."""
