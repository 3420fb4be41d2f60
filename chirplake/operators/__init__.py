"""DataFrame -> DataFrame steps: layers, profiles, application, evaluation."""
