"""DataFrame -> DataFrame operators over keyed daily series."""
