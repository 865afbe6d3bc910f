"""labelscope: DataFrame operators for labelled text, from corpus profile to model scoreboard."""
